"""Tables that are replaced without a gap for their readers.

A table is a folder of parts, each written once under a name of its own, and of numbered
manifests that list the parts a version consists of. A load writes its parts first and
creates the next manifest last, which is what switches readers: a load that dies
half-way leaves the version before it, whole. A file system that creates a file only if it
is not there lets one of two loads at the same time win; the other one raises.

Parts hold all columns, so a version is read from its parts' paths alone. Parts of a
partition are listed under its value, and a reader who names values reads these only.

A load may have a name. A load of the name that the table's last load had is not done
again. Old versions stay readable until ``remove_old`` is called.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

MANIFESTS = "_manifests"
PART = "__part"
REPLACE, PARTITIONS, APPEND = "replace", "partitions", "append"


class Folder:
    """A folder of the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = path.rstrip("/")
        self.files = self.jvm.org.apache.hadoop.fs.Path(path).getFileSystem(
            spark._jsc.hadoopConfiguration())

    def at(self, name: str = ""):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        if not self.files.exists(self.at(name)):
            return []
        return [status.getPath().getName() for status in self.files.listStatus(self.at(name))]

    def read(self, name: str) -> str:
        """Text of a small file; a ValueError if its bytes are not what was written."""
        stream = self.files.open(self.at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() != "ChecksumException":
                raise
            raise ValueError(f"{name} is damaged") from error
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a new file; raises if it is there."""
        stream = self.files.create(self.at(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self.files.delete(self.at(name), True)


def manifests(spark: SparkSession, path: str) -> list[dict]:
    """All whole manifests of a table, oldest first."""
    folder = Folder(spark, path)
    found = []
    for name in sorted(folder.names(MANIFESTS)):
        if name.endswith(".json"):
            try:
                found.append(json.loads(folder.read(f"{MANIFESTS}/{name}")))
            except ValueError:  # a load died while it wrote its manifest
                continue
    return found


def current(spark: SparkSession, path: str) -> dict | None:
    """The newest whole manifest, or nothing."""
    folder = Folder(spark, path)
    for name in sorted(folder.names(MANIFESTS), reverse=True):
        if name.endswith(".json"):
            try:
                return json.loads(folder.read(f"{MANIFESTS}/{name}"))
            except ValueError:
                continue
    return None


def publish(
    df: DataFrame, path: str, partition: str | None = None, how: str = REPLACE,
    load: str | None = None,
) -> DataFrame:
    """Make ``df`` the table's next version and return it as readers see it.

    ``how`` is "replace" (the whole table), "partitions" (those that ``df`` has) or
    "append". ``load`` names the load: repeated, it changes nothing.
    """
    spark = df.sparkSession
    before = current(spark, path)
    if load is not None and before is not None and before["load"] == load:
        return read_published(spark, path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema]).json()
    if before is not None and how != REPLACE and before["schema"] != schema:
        raise ValueError("a version's columns may only change when the whole table is replaced")
    folder = Folder(spark, path)
    name = f"part-{uuid.uuid4().hex}"
    written = df if partition is None else df.withColumn(PART, F.col(partition).cast("string"))
    if partition is None:
        written.write.parquet(f"{path}/{name}")
        new = {"": [name]}
    else:
        # Rows are dealt out by partition, and AQE cuts the large ones.
        written.hint("rebalance", PART).write.partitionBy(PART).parquet(f"{path}/{name}")
        new = {
            sub.split("=", 1)[1]: [f"{name}/{sub}"]
            for sub in folder.names(name) if sub.startswith(f"{PART}=")
        }
    parts = {} if before is None or how == REPLACE else dict(before["parts"])
    for value, paths in new.items():
        parts[value] = paths if how == PARTITIONS else parts.get(value, []) + paths
    _switch(folder, {
        "load": load, "partition": partition, "schema": schema, "parts": parts,
    }, before)
    return read_published(spark, path)


def _switch(folder: Folder, manifest: dict, before: dict | None) -> None:
    """Create the next manifest. Another one of its number, even a broken one, is in the way."""
    known = [int(n.split(".")[0]) for n in folder.names(MANIFESTS) if n.endswith(".json")]
    number = max(known, default=0) + 1
    latest = before["version"] if before else 0
    newer = [n for n in known if n > latest]
    if any(_readable(folder, n) for n in newer):
        raise RuntimeError("another load has published a version meanwhile")
    folder.create(_file(number), json.dumps({"version": number} | manifest))


def _file(number: int) -> str:
    return f"{MANIFESTS}/{number:012d}.json"


def _readable(folder: Folder, number: int) -> bool:
    try:
        return bool(json.loads(folder.read(_file(number))))
    except ValueError:
        return False


def read_published(
    spark: SparkSession, path: str, values: Sequence[str] | None = None, version: int | None = None
) -> DataFrame:
    """The table's newest version, or an older one; ``values`` are partition values."""
    if version is None:
        manifest = current(spark, path)
    else:
        manifest = next((m for m in manifests(spark, path) if m["version"] == version), None)
    if manifest is None:
        raise FileNotFoundError(f"no version of a table at {path}")
    schema = T.StructType.fromJson(json.loads(manifest["schema"]))
    wanted = manifest["parts"] if values is None else {
        v: manifest["parts"][v] for v in map(str, values) if v in manifest["parts"]}
    paths = [f"{path}/{part}" for parts in wanted.values() for part in parts]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def remove_old(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the last ``keep`` versions and what only they, or no version, used.

    Returns the number of parts deleted. Not to be called while a load is running.
    """
    folder = Folder(spark, path)
    known = manifests(spark, path)
    kept = known[-max(1, keep):]
    used = {part.split("/")[0] for m in kept for parts in m["parts"].values() for part in parts}
    numbers = {m["version"] for m in kept}
    for name in folder.names(MANIFESTS):
        if name.endswith(".json") and int(name.split(".")[0]) not in numbers:
            folder.delete(f"{MANIFESTS}/{name}")
    old = [n for n in folder.names() if n.startswith("part-") and n not in used]
    for name in old:
        folder.delete(name)
    return len(old)
