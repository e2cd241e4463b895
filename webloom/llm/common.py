"""What the operators share: tables in the shared folder, hot keys, bounded samples, grouped batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import fields
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from webloom.session import ensure_checkpoint_dir

# A key is hot from this share of all rows on. As the counts of all keys add up to all rows, there
# are at most HOT_PART hot keys whatever the size of the table, so their list may be broadcast.
HOT_PART = 1000


def shared_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet below ``spark.checkpoint.dir`` and read it back: compressed, pruned by
    column, and there for every executor that comes later."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_counted(big: DataFrame, small: DataFrame, on: str, total: int) -> DataFrame:
    """Inner equi join of a skewed table with a table of distinct keys whose column ``n`` counts the
    key's rows in ``big`` (``total`` rows together). Hot keys, at most ``HOT_PART`` by arithmetic, are
    joined where their rows are; the others shuffle. ``big`` should be a written table."""
    hot = small["n"] * HOT_PART >= F.lit(total)
    there = big.join(F.broadcast(small.where(hot)), on)
    return there.unionByName(big.join(small.where(~hot), on))


def unit_hash(*keys: Column) -> Column:
    """A repeatable number in [0, 1) for each key."""
    return F.pmod(F.xxhash64(*keys), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bounded_sample(rows: DataFrame, key: str, bound: int, stratum: str) -> DataFrame:
    """About ``bound`` rows of each value of ``stratum``, all if there are no more, picked by a hash
    of ``key``; column ``share`` holds the part of its stratum that was picked. Of rows that repeat a
    key one is taken, so a key with many rows does not break the bound."""
    share = F.least(F.lit(1.0), F.lit(float(bound)) / F.count(F.lit(1)))
    shares = rows.groupBy(stratum).agg(share.alias("share"))
    # One row for each label value; training refuses label sets that are not small.
    labelled = rows.join(F.broadcast(shares.limit(MAX_LABELS + 1)), stratum)
    return one_of_each(labelled.where(unit_hash(F.col(key)) < F.col("share")), key)


def one_of_each(rows: DataFrame, key: str) -> DataFrame:
    """Of the rows with one ``key`` that whose other columns come first in order; the columns of
    ``rows``. Rows are cut down before the shuffle."""
    rest = [c for c in rows.columns if c != key]
    least = rows.groupBy(key).agg(F.min(F.struct(*rest)).alias("_least"))
    return least.select(*[F.col(c) if c == key else F.col("_least")[c].alias(c) for c in rows.columns])


# Most label values of a classifier.
MAX_LABELS = 1000


def groups(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition that is sorted by ``keys``, each whole, though it may span batches.
    Callers bound the size of a group beforehand."""
    rest: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        values = [batch[k].to_numpy() for k in keys]
        change = np.zeros(len(batch), dtype=bool)
        change[0] = not rest or any(rest[-1][k].iloc[0] != v[0] for k, v in zip(keys, values))
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        starts = np.flatnonzero(change)
        if not len(starts):
            rest.append(batch)
            continue
        if starts[0]:
            rest.append(batch.iloc[: starts[0]])
        if rest:
            yield pd.concat(rest) if len(rest) > 1 else rest[0]
        for start, end in zip(starts[:-1], starts[1:]):
            yield batch.iloc[start:end]
        rest = [batch.iloc[starts[-1] :]]
    if rest:
        yield pd.concat(rest) if len(rest) > 1 else rest[0]


def map_batches(
    df: DataFrame, carry: list[str], new: str, compute: Callable[[pa.RecordBatch], list]
) -> DataFrame:
    """The columns ``carry`` of ``df`` as they are, nulls and large integers included, and the columns
    ``new`` (a schema string) that ``compute`` makes from each Arrow batch, row by row."""
    schema = T.StructType([df.schema[c] for c in carry] + list(T.StructType.fromDDL(new)))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = compute(batch)
            types = [f.type for f in arrow][len(carry) :]
            columns = [pa.array(values, type=kind) for values, kind in zip(made, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in carry] + columns, schema=arrow)

    return df.mapInArrow(run, schema)


def keep_rows(df: DataFrame, column: str, test: Callable[[list], list[bool]]) -> DataFrame:
    """The rows of ``df``, whole and in place, whose ``column`` passes ``test``, given batchwise."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(test(batch.column(column).to_pylist()), type=pa.bool_()))

    return df.mapInArrow(run, df.schema)


def plain(made) -> tuple:
    """The fields of a dataclass, for a broadcast: workers unpickle those without this package."""
    return tuple(getattr(made, f.name) for f in fields(made))


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows of ``batch`` whose strings in ``column`` have together at most ``most`` bytes, or
    one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def lists_of(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
    """The cells of a list column without nulls, as arrays that share one buffer."""
    values = batch.column(column)
    ends = values.offsets.to_numpy()
    flat = values.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]
