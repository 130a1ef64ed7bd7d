"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession

from wardflow.session import work_path
from wardflow.sources.tables import hand_off

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python may not have it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    base = os.path.join(tempfile.mkdtemp(), "wardflow")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", top, "wardflow"))
    _shipped.add(app)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table."""
    return hand_off(df, work_path(df.sparkSession, label))


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text each."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for i, n in enumerate(lengths):
        if size and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows:
        yield batch.slice(start)
