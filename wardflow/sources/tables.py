"""Parquet hand-off between steps and the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardflow.operators.attach import attach
from wardflow.operators.quality import enforce
from wardflow.session import short_table
from wardflow.sources.csvfile import natural, plain_path
from wardflow.sources.versions import publish


def hand_off(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write a step's result as Parquet and go on from the written table."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def positions(scan: DataFrame, name: str) -> DataFrame:
    """Add the place of each row, from 1, in the order of a Parquet table's files.

    Straight on a scan. Rows know their number within their file; only the sizes of files,
    one row each, are summed up.
    """
    paths = [plain_path(p) for p in sorted(scan.inputFiles(), key=natural)]
    files = short_table(
        scan.sparkSession, [(p, i) for i, p in enumerate(paths)],
        {"__path": "string", "__file": "bigint"})
    rows = scan.select(
        "*", F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("__path"),
        F.col("_metadata.row_index").alias("__row"))
    rows = attach(rows, files, ["__path"], max_rows=len(paths))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n")).select(
        "__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    return attach(rows, starts, ["__file"]).select(
        *scan.columns, (F.col("__start") + F.col("__row") + 1).alias(name))


def _load(df: DataFrame, path: str, partition: str, replaced: str) -> DataFrame:
    """Write by partition value; rows are dealt out by it, and AQE cuts the large ones."""
    (
        df.hint("rebalance", partition)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", replaced)
        .partitionBy(partition)
        .parquet(path)
    )
    return df.sparkSession.read.parquet(path)


def load_table(df: DataFrame, path: str, partition: str) -> DataFrame:
    """Replace a whole table; partitions that ``df`` does not have go."""
    return _load(df, path, partition, "static")


def load_partitions(df: DataFrame, path: str, partition: str) -> DataFrame:
    """Replace the partitions present in ``df`` and leave all others."""
    return _load(df, path, partition, "dynamic")


def load_checked(
    df: DataFrame, report: DataFrame, path: str, partition: str, blocking: bool = True,
    load: str | None = None,
) -> DataFrame:
    """Publish a table's next version only if no blocking rule of its report failed.

    Readers have the version before until the new one is whole, see ``sources.versions``.
    """
    enforce(report, blocking)
    return publish(df, path, partition, load=load)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, batch: int = 10_000) -> None:
    """Append to a relational table, in batches, one connection per partition."""
    (
        df.write.mode("append")
        .option("batchsize", batch)
        .jdbc(url, table, properties=properties)
    )


def read_tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    """Parquet tables of a folder, by name."""
    return {name: spark.read.parquet(f"{folder}/{name}.parquet") for name in names}
