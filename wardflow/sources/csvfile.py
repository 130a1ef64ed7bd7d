"""Raw delimited files: every cell read as text, file order kept."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from wardflow.functions.text import NULL_TOKENS, missing_to_null
from wardflow.operators.attach import attach
from wardflow.session import materialise, short_table

ORDER = "_seq"
BAD = "_invalide"


def read_raw_csv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = NULL_TOKENS,
    multi_line: bool = False,
    bad_records: str = "raise",
) -> DataFrame:
    """Read a CSV with header as texts, plus its file order in ``_seq``.

    With ``columns`` no file is opened to learn the schema, and a header that
    disagrees is an error. ``multi_line`` allows line breaks inside quotes; files are
    split among tasks all the same, see :func:`quoted_records`.

    A record with more or fewer cells than columns, which is also what a line break
    inside quotes makes without ``multi_line``, raises when it is read. With
    ``bad_records="keep"`` its line stands whole in ``_invalide``, null elsewhere,
    and its cells are what could be read; this needs ``columns``.
    """
    keep = bad_records == "keep"
    if bad_records not in ("raise", "keep") or (keep and columns is None):
        raise ValueError("bad_records is 'raise', or 'keep' together with columns")
    options = {
        "escape": '"', "encoding": "UTF-8", "mode": "PERMISSIVE" if keep else "FAILFAST",
        "columnNameOfCorruptRecord": BAD, "multiLine": str(multi_line).lower(),
    }
    # A record is checked whole, whatever columns are asked for.
    reader = spark.read.options(
        header=True, enforceSchema=False, columnPruning=False, **options)
    if multi_line and columns is None:
        columns = reader.csv(path).columns
    if columns is not None:
        names = [*columns, BAD] if keep else columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
        if multi_line:
            return _parsed(quoted_records(spark, path), schema, list(columns), options, null_tokens)
        reader = reader.schema(schema)
    return with_file_order(reader.csv(path), null_tokens)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files with line breaks inside quotes: ``__record`` and its place.

    ``__top`` tells the first record of a file.

    Files are read as lines, by byte ranges. A line lies inside quotes if the quotes before
    it in its file are odd in number (a doubled quote counts twice), so:

    1. Every range tells the parity of its quotes and, for the case that it begins inside
       quotes, whether a record begins in it. From these, one row per range, follow the
       state each range begins in and the range in which the record that it continues began.
    2. In a range without open quotes lines are records. The lines of other ranges are
       dealt out by range and joined between their starts; what begins in one range and
       ends in another is put together at the end, two pieces at most per range.

    Lines end with a line feed, before which a carriage return is dropped at the end of a
    record and kept inside quotes. Quotes count wherever they stand.
    """
    lines = _placed(spark.read.option("lineSep", "\n").text(path))
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    odd = quotes % 2
    here = ["__file", "__offset"]
    ranges = materialise(lines.groupBy(*here).agg(
        (F.sum(odd) % 2).alias("__parity"),
        F.min(F.when(odd == 1, F.col("__row"))).alias("__first"),
        F.max("__row").alias("__last"),
        F.min("__row").alias("__begin"),
    ))
    before = Window.partitionBy("__file").orderBy("__offset").rowsBetween(
        Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("__parity").over(before), F.lit(0)) % 2
    begins = (F.col("__inside") == 0) | F.coalesce(F.col("__first") < F.col("__last"), F.lit(False))
    ranges = ranges.withColumn("__inside", inside).select(
        *here, "__inside",
        ((F.col("__inside") == 1) | F.col("__first").isNotNull()).alias("__open"),
        F.coalesce(
            F.last(F.when(begins, F.col("__offset")), ignorenulls=True).over(before),
            F.col("__offset")).alias("__head"),
        F.when(F.col("__offset") == 0, F.col("__begin")).otherwise(-1).alias("__begin"),
    )
    known = F.coalesce("__open", F.raise_error(F.lit("a file has changed while it was read")))
    marked = attach(lines, ranges, here).withColumn("__open", known)
    plain = marked.where(~F.col("__open")).select(
        *here, "__row", (F.col("__row") == F.col("__begin")).alias("__top"),
        F.col("value").alias("__record"))

    in_range = Window.partitionBy(*here).orderBy("__row")
    earlier = in_range.rowsBetween(Window.unboundedPreceding, -1)
    state = (F.col("__inside") + F.coalesce(F.sum("__odd").over(earlier), F.lit(0))) % 2
    joined = F.concat_ws("\n", F.transform(
        F.sort_array(F.collect_list(F.struct("__row", "value"))), lambda line: line["value"]))
    records = (
        marked.where("__open").withColumn("__odd", odd).withColumn("__state", state)
        .withColumn("__number", F.count_if(F.col("__state") == 0).over(in_range))
        .groupBy(*here, "__number")
        .agg(F.min("__row").alias("__row"), F.max("__begin").alias("__begin"),
             joined.alias("__record"), (F.sum("__odd") % 2).alias("__odd"),
             F.max("__head").alias("__head"))
        .select(
            *here, "__number", "__row", (F.col("__row") == F.col("__begin")).alias("__top"),
            "__record",
            # Without a start, or without an end.
            ((F.col("__number") == 0) | (F.col("__odd") == 1)).alias("__piece"),
            F.when(F.col("__number") == 0, F.col("__head")).otherwise(F.col("__offset")).alias("__head"),
        )
    )
    # Both read all columns, so that the lines are dealt out once for the two of them.
    whole = records.where(~F.col("__piece") & F.col("__head").isNotNull()).select(*plain.columns)
    parts = F.sort_array(
        F.collect_list(F.struct("__offset", "__number", "__record", "__row", "__top")))
    across = (
        records.where("__piece")
        .groupBy("__file", "__head").agg(parts.alias("__parts"))
        .select(
            "__file", F.col("__head").alias("__offset"), F.col("__parts")[0]["__row"].alias("__row"),
            F.col("__parts")[0]["__top"].alias("__top"),
            F.concat_ws("\n", F.transform("__parts", lambda part: part["__record"])).alias("__record"),
        )
    )
    return plain.unionByName(whole).unionByName(across)


def _parsed(
    records: DataFrame, schema: T.StructType, columns: list[str], options: dict, null_tokens: Sequence[str]
) -> DataFrame:
    """Cells of records; the first record of each file must be the header."""
    text = F.regexp_replace("__record", "\\r$", "")
    rows = records.withColumn("__record", text)
    header = F.from_csv(
        F.regexp_replace("__record", "^\ufeff", ""), _ddl(columns), options | {"mode": "PERMISSIVE"})
    agrees = F.lit(True)
    for i, column in enumerate(columns):
        agrees = agrees & header.getField(column).eqNullSafe(F.lit(column))
    checked = F.when(F.col("__top"), F.when(agrees, F.lit(False)).otherwise(
        F.raise_error(F.concat(F.lit("CSV header does not agree with the columns: "), "__record")).cast("boolean")))
    body = rows.where(F.coalesce(checked, F.trim("__record") != ""))
    cells = body.select(
        F.from_csv("__record", _ddl(schema.names), options).alias("__cells"), _order_number().alias(ORDER))
    return cells.select(
        *[
            missing_to_null(F.col("__cells")[f.name], null_tokens).alias(f.name)
            if null_tokens and f.name != BAD else F.col("__cells")[f.name].alias(f.name)
            for f in schema.fields
        ],
        ORDER,
    )


def natural(path: str) -> list:
    """Sort key that takes runs of digits as numbers."""
    return [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"(\d+)", path)]


def plain_path(path: str) -> str:
    """Local paths are written with one slash or three."""
    return re.sub("^file:/+", "file:/", path)


def _ddl(names: Sequence[str]) -> str:
    return ", ".join("`" + name.replace("`", "``") + "` STRING" for name in names)


def with_file_order(scan: DataFrame, null_tokens: Sequence[str] = ()) -> DataFrame:
    """Add the position of each row, straight on a file scan.

    Files are ranked by path, their numbers as numbers; offset and row number put
    splits and rows in order. All three are packed into one number, which hash
    aggregation takes. Positions are only ever compared.
    """
    rows = _placed(scan)
    cells = [
        missing_to_null(F.col(c), null_tokens).alias(c) if null_tokens and c != BAD else F.col(c)
        for c in scan.columns
    ]
    return rows.select(*cells, _order_number().alias(ORDER))


def _placed(scan: DataFrame) -> DataFrame:
    """Rank of each row's file, offset of its split and number within its task."""
    rows = scan.select(
        "*",
        # Local paths are written with one slash here and with three in the list.
        F.regexp_replace("_metadata.file_path", "^file:/+", "file:/").alias("__path"),
        F.col("_metadata.file_block_start").alias("__offset"),
        # The lower 33 bits number the rows of a task.
        F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("__row"),
    )
    paths = [plain_path(p) for p in sorted(scan.inputFiles(), key=natural)]
    files = short_table(
        scan.sparkSession, [(p, i) for i, p in enumerate(paths)],
        {"__path": "string", "__file": "bigint"},
    )
    return attach(rows, files, ["__path"], max_rows=len(paths)).drop("__path")


def _order_number() -> Column:
    digits = F.concat(*[
        F.lpad(F.col(c).cast("string"), width, "0")
        for c, width in (("__file", 10), ("__offset", 16), ("__row", 10))
    ])
    return digits.cast("decimal(38,0)")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write UTF-8 CSV files with header; spaces around a text are kept."""
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
