"""Session settings, the shared work folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Timestamps in the data carry no zone, so differences are taken in UTC; the
# adaptive settings let Spark size shuffle partitions and split skewed joins
# from what it measures at run time.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method above 8,000 bytecodes. A projection over
    # twenty repaired columns exceeds that and would run interpreted, so such
    # stages use Spark's split projections instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_own_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings every operator relies on."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "wardflow", master: str | None = None, **settings) -> SparkSession:
    """Create a session; keyword settings use ``__`` for the dots in a name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the one the cluster names.

    A session without one gets its own temporary folder in local mode only,
    because on a cluster that folder would exist on the driver alone.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        _own_dirs[app] = tempfile.mkdtemp(prefix="wardflow-")
    return _own_dirs[app]


def run_dir(spark: SparkSession) -> str:
    """The application's own folder in the shared one; all work paths are in it."""
    return f"{shared_dir(spark).rstrip('/')}/wardflow-{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, label: str) -> str:
    """A new path in the application's folder, never used before."""
    return f"{run_dir(spark)}/{label}-{uuid.uuid4().hex}"


def clean(spark: SparkSession) -> bool:
    """Delete what the application has put into the shared folder.

    Call it when no result is needed any more: results may still read from there.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


ARROW_TYPES = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
}


def short_table(spark: SparkSession, rows: list[tuple], columns: dict[str, str]) -> DataFrame:
    """Table of a few literal rows; ``columns`` maps names to types.

    Passed as Arrow it becomes a local relation, whose size the optimizer knows
    and which starts no job and no Python worker.
    """
    values = list(zip(*rows)) if rows else [()] * len(columns)
    arrays = [
        pa.array(column, ARROW_TYPES[kind]) for column, kind in zip(values, columns.values())
    ]
    return spark.createDataFrame(pa.table(arrays, names=list(columns)))


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and cut its lineage.

    Parquet rather than a checkpoint: later steps read the columns they need, and
    the planner knows the size.
    """
    path = work_path(df.sparkSession, "step")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
