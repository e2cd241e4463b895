"""Joins and numberings that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webloom.session import cut_lineage

# Rows of a hot key that stay together; a key is hot if it has more.
HOT_ROWS = 500_000
# At most this many keys are treated as hot, so the broadcast list has a fixed bound. What comes
# after them holds less than a ten-thousandth of all rows each.
MAX_HOT_KEYS = 10_000
SALT = "_salt"


def hot_keys(
    df: DataFrame,
    on: list[str],
    min_rows: int = HOT_ROWS,
    weight: str | None = None,
) -> DataFrame:
    """The most frequent keys of ``df``, each with the number of parts it is to be split into, one for
    every ``min_rows`` of its rows: at most ``MAX_HOT_KEYS`` rows, found by a top-k.

    ``weight`` names a column that already holds the number of rows of each key, which saves the
    count. Keys beyond the list cannot be large: each holds less than 1/``MAX_HOT_KEYS`` of all rows.
    """
    counted = (
        df.select(*on, F.col(weight).alias("_n"))
        if weight
        else df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    )
    return (
        counted.where(F.col("_n") > min_rows)
        .orderBy(F.desc("_n"), *on)
        .limit(MAX_HOT_KEYS)
        .select(*on, F.ceil(F.col("_n") / F.lit(min_rows)).cast("int").alias("_parts"))
    )


def join_skewed(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Equi join whose left side may be skewed and whose right side has few rows for each key.

    Rows of hot keys are spread over the key's parts by a hash of their exact columns, which a
    retried task computes again in the same way; the matching rows on the right are repeated once
    for each part. Rows whose key is null match nothing and are spread as well. All other keys join
    as usual. ``how`` may be inner, left, left_semi or left_anti.

    Without ``hot`` the keys of ``big`` are counted first, so ``big`` should be a table and not a
    costly pipeline.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join_skewed cannot do a {how!r} join")
    hot = hot if hot is not None else hot_keys(big, on, min_rows)
    left, right = salted(big, on, hot), salted_match(small, on, hot)
    return left.join(right, [*on, SALT], how).drop(SALT)


def salted(big: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """The skewed side of a salted join: ``big`` with its part number."""
    spread = F.xxhash64(*_exact_columns(big, on))
    no_key = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    # The list of hot keys has at most MAX_HOT_KEYS rows.
    marked = big.join(F.broadcast(hot), on, "left")
    part = (
        F.when(no_key, F.pmod(spread, F.lit(1 << 30)))
        .when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts")))
        .otherwise(F.lit(0))
    )
    return marked.withColumn(SALT, part.cast("int")).drop("_parts")


def salted_match(small: DataFrame, on: list[str], hot: DataFrame) -> DataFrame:
    """The other side: rows of hot keys once for each part."""
    last = F.coalesce(F.col("_parts"), F.lit(1)) - F.lit(1)
    marked = small.join(F.broadcast(hot), on, "left")
    return marked.withColumn(SALT, F.explode_outer(F.sequence(F.lit(0), last))).drop("_parts")


def _exact_columns(df: DataFrame, on: list[str]) -> list[str]:
    """Columns fit for a repeatable salt. A sum of doubles may differ in its last bit when a lost
    task runs again, which would send a row to another part."""
    exact = (T.StringType, T.IntegralType, T.DecimalType, T.DatetimeType, T.BooleanType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, exact)] or on


def numbered(
    df: DataFrame,
    order: list[str],
    out: str,
    group: list[str] | None = None,
    partitions: int | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Number rows 1, 2, 3, ... in ``order`` inside each ``group``, or over the whole table. With
    ``weight``, a column of whole numbers, a row takes so many places and gets the last of them.

    A plain ``row_number`` would sort a whole group in one task. Here the rows are cut into ranges
    of ``(group, order)`` by sampled bounds, so a large group spreads over many ranges, and equal
    values do as long as a later column tells them apart. Each range is numbered on its own and
    starts after the rows of the ranges before it. The ranges are written once, so that counts and
    numbers see the same cut even if a task is lost.
    """
    group = group or []
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = df.repartitionByRange(partitions, *group, *order)
    ranged = cut_lineage(cut.withColumn("_range", F.spark_partition_id()))
    part = [*group, "_range"]
    # One row for each group and range: a group has no more of them than there are ranges.
    before = Window.partitionBy(*(group or [F.lit(0)])).orderBy("_range")
    counted_before = F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        ranged.groupBy(*part)
        .agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_n"))
        .withColumn("_start", F.coalesce(counted_before, F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(*part).orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = ranged.withColumn("_at", F.sum(weight).over(so_far) if weight else F.row_number().over(inside))
    same = [F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}")) for c in part]
    joined = keyed.alias("k").join(starts.alias("s"), reduce(Column.__and__, same), "inner")
    return joined.select(
        *[F.col(f"k.{c}") for c in df.columns],
        (F.col("k._at") + F.col("s._start")).cast("bigint").alias(out),
    )
