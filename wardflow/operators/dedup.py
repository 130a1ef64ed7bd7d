"""Duplicate removal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from wardflow.session import materialise

# Numbers of 64 bits that mark the keys with several rows: 64 million bits, which are
# some 50 MB on each executor however many rows there are.
MARK_WORDS = 1 << 20


def parted(df: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that are alone with their key, and all others; null keys are one key.

    Hashes of the keys are counted first, and those that came several times become bits
    of a table of bounded size, which is broadcast. A row whose bit is not set is alone with its
    key and needs no shuffle. Of keys that share a bit, all rows are among the others,
    so the fuller the table is, the more rows take the longer way to the same result.

    The rows are read three times, so they are written first.
    """
    df = materialise(df)
    spot = F.xxhash64(*keys).bitwiseAND(F.lit(MARK_WORDS * 64 - 1))
    several = (
        df.groupBy(F.xxhash64(*keys).alias("__hash"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 1)
        .select(F.col("__hash").bitwiseAND(F.lit(MARK_WORDS * 64 - 1)).alias("__spot"))
    )
    marks = F.broadcast(materialise(
        several.groupBy(F.shiftright("__spot", 6).alias("__word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(__spot & 63 as int))")).alias("__bits"))
    ))
    place = spot.bitwiseAND(F.lit(63).cast("bigint")).cast("int")
    marked = (F.shiftright(spot, 6) == F.col("__word")) & (F.getbit("__bits", place) == 1)
    return df.join(marks, marked, "left_anti"), df.join(marks, marked, "left_semi")


def drop_exact_duplicates(df: DataFrame, order: str) -> DataFrame:
    """Keep one of the rows that agree on everything but ``order``.

    The first position is kept. Copies collapse before the shuffle, and rows
    are spread by their whole content, so neither many copies of one row nor
    many rows of one key fill a single task.
    """
    content = [c for c in df.columns if c != order]
    return df.groupBy(*content).agg(F.min(order).alias(order)).select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: str, by_digest: bool = False) -> DataFrame:
    """Keep the last row of each key; null keys are one key.

    Asking for rank one only lets Spark discard all but the last row of each
    key inside every map task, so a hot key sends one row per task. ``by_digest``
    compares long keys by SHA-256: they then go through the shuffle only if the result
    is asked for them.
    """
    by = [digest(df, *keys)] if by_digest else keys
    newest_first = Window.partitionBy(*by).orderBy(F.col(order).desc())
    return (
        df.withColumn("__rank", F.row_number().over(newest_first))
        .where(F.col("__rank") == 1)
        .drop("__rank")
    )


def deduplicate(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Exact copies first, then the last remaining row of each key.

    The two passes are not one: with rows A, B, A under a key, A collapses to
    its first position and B is the last. Only rows that share their key are shuffled.
    """
    alone, others = parted(df, keys)
    return alone.unionByName(keep_last(drop_exact_duplicates(others, order), keys, order))


def deduplicate_counted(
    df: DataFrame, keys: list[str], order: str, copies: str, versions: str
) -> DataFrame:
    """As :func:`deduplicate`, with what each remaining row stands for.

    ``copies`` is the number of raw rows of the key and ``versions`` that of
    its distinct ones, so the totals before each pass can be read off the
    result. Both passes combine before their shuffle.
    """
    alone, others = parted(df, keys)
    content = [c for c in df.columns if c != order]
    distinct = others.groupBy(*content).agg(
        F.min(order).alias(order), F.count(F.lit(1)).alias("__n")
    )
    # Which position wins is decided on keys and positions alone; the rows at these
    # positions are then joined by sorting, which spills where a hash table could not.
    # Both sides name the same columns of the distinct rows, so these are dealt out once.
    winners = (
        distinct.groupBy(*keys)
        .agg(
            F.max(order).alias("__winner"),
            F.max_by("__n", order).alias("__winner_n"),
            F.sum("__n").alias("__copies"),
            F.count(F.lit(1)).alias("__versions"),
        )
        .select("__winner", "__winner_n", "__copies", "__versions")
    )
    won = distinct.join(
        winners, (F.col(order) == F.col("__winner")) & (F.col("__n") == F.col("__winner_n"))
    ).select(*df.columns, F.col("__copies").alias(copies), F.col("__versions").alias(versions))
    one = F.lit(1).cast("bigint")
    return alone.select(*df.columns, one.alias(copies), one.alias(versions)).unionByName(won)


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """One value: rows beyond the first of each key; null keys equal each other."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    return per_key.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("repeated"))


def duplicate_counts(df: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Rows, rows beyond the first of each equal row, and of each key.

    Keys are counted over the distinct rows, so a raw file is read once.
    """
    content = [c for c in df.columns if c != order]
    # Rows are compared by digest, so the shuffles carry two of them and a count.
    distinct_rows = (
        df.groupBy(digest(df, *keys).alias("__key"), digest(df, *content).alias("__whole"))
        .agg(F.count(F.lit(1)).alias("__n"))
    )
    per_key = distinct_rows.groupBy("__key").agg(
        F.sum("__n").alias("__n"), F.sum(F.col("__n") - 1).alias("__copies"))
    rows = F.coalesce(F.sum("__n"), F.lit(0))
    return per_key.agg(
        rows.alias("lignes"),
        F.coalesce(F.sum("__copies"), F.lit(0)).alias("doublons_stricts"),
        (rows - F.count(F.lit(1))).alias("cles_dupliquees"),
    )


def digest(df: DataFrame, *columns: str) -> Column:
    """SHA-256 of some columns of ``df``; nulls equal each other and nothing else.

    Every cell is its text behind its length, so cells cannot run into one another; of
    nested cells the text is their JSON.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}

    def cell(name: str) -> Column:
        nested = isinstance(kinds[name], (T.ArrayType, T.MapType, T.StructType))
        text = F.to_json(F.col(name)) if nested else F.col(name).cast("string")
        return F.coalesce(F.concat(F.length(text), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*[cell(name) for name in columns]), 256))
