"""Robots rules of a host as a sorted array that an address searches in logarithmic time.

A rule path is a literal head, then literal pieces between ``*``, then perhaps ``$``. All heads that
an address starts with are heads of the greatest head that is not greater than the address, so one
binary search finds that head and its chain holds every other candidate. The pieces after a head are
looked for one after the other; no pattern is compiled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def indexed_rules(rules: DataFrame, head: Column, entry: Column) -> DataFrame:
    """``(host, _index, _chains, _odd)``, one row for each host, as large as its robots text.

    ``_index`` holds ``(head, entries)`` in byte order of the heads; ``_chains`` holds for each of
    them the places of all heads it starts with, itself last. ``_odd`` holds the entries of rules
    whose head is null.
    """
    by_head = (
        rules.select("host", head.alias("head"), entry.alias("entry"))
        .groupBy("host", "head")
        .agg(F.collect_set("entry").alias("entries"))
    )
    has_head = F.col("head").isNotNull()
    listed = by_head.groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(has_head, F.struct("head", "entries")))).alias("_index"),
        F.flatten(F.collect_list(F.when(~has_head, F.col("entries")))).alias("_odd"),
    )
    return listed.withColumn("_chains", _chains(F.transform("_index", lambda e: e["head"])))


@F.pandas_udf(T.ArrayType(T.ArrayType(T.IntegerType())))
def _chains(heads: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in heads:
        yield batch.map(prefix_chains)


def prefix_chains(heads) -> list[list[int]]:
    """For each of the sorted ``heads`` the places of those it starts with. Together the chains are
    no longer than the heads are in characters, plus one for each."""
    chains, open_places = [], []
    for place, head in enumerate(heads):
        while open_places and not head.startswith(heads[open_places[-1]]):
            open_places.pop()
        open_places.append(place)
        chains.append(list(open_places))
    return chains


def fitting(target: Column) -> Column:
    """Entries of all heads that ``target`` starts with; null without rules or without a target."""
    index, chains = F.col("_index"), F.col("_chains")

    def search(text: Column) -> Column:
        # As many halvings as the number of places has binary digits.
        steps = F.sequence(F.lit(1), F.length(F.bin(F.size(index))))

        def halve(span: Column, _: Column) -> Column:
            middle = F.floor((span["low"] + span["high"]) / F.lit(2)).cast("int")
            return F.when(
                F.get(index, middle)["head"] <= text,
                F.struct(middle.alias("low"), span["high"].alias("high")),
            ).otherwise(F.struct(span["low"].alias("low"), middle.alias("high")))

        whole = F.struct(F.lit(-1).alias("low"), F.size(index).alias("high"))
        floor = F.aggregate(steps, whole, halve, lambda span: span["low"])
        places = F.filter(
            F.get(chains, floor), lambda i: F.startswith(text, F.get(index, i)["head"])
        )
        return F.flatten(F.transform(places, lambda i: F.get(index, i)["entries"]))

    # As an element of an array the target is worked out once and not in every step.
    return F.get(F.transform(F.array(target), search), 0)


def pattern_head(path: Column) -> Column:
    """What an address has to start with if the rule ``path`` fits it."""
    return F.get(_pieces(path), 0)


def pattern_tail(path: Column) -> Column:
    """The rest of a rule: ``start`` (place after the head), ``middle`` (pieces in order), ``last``
    (what the address ends with, null if the end is open), ``whole`` (the head is all of it)."""
    pieces, closed = _pieces(path), F.endswith(path, F.lit("$"))
    found = F.filter(F.slice(pieces, 2, F.size(pieces)), lambda piece: piece != "")
    # A star before the dollar sign leaves the end open.
    bound = closed & (F.size(pieces) > 1) & (F.element_at(pieces, -1) != "")
    middle = F.when(bound, F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0)))).otherwise(found)
    return F.struct(
        (F.length(F.get(pieces, 0)) + 1).alias("start"),
        middle.alias("middle"),
        F.when(bound, F.element_at(pieces, -1)).alias("last"),
        (closed & (F.size(pieces) == 1)).alias("whole"),
    )


def tail_fits(tail: Column, target: Column) -> Column:
    """True if the pieces of ``tail`` follow in ``target``, whose head fits already."""

    def after(place: Column, piece: Column) -> Column:
        found = F.position(piece, target, place)
        hit = F.when(found > 0, found + F.length(piece)).otherwise(F.lit(0))
        return F.when(place > 0, hit).otherwise(F.lit(0))

    reached = F.aggregate(tail["middle"], tail["start"], after)
    room = F.length(target) - F.length(tail["last"]) + 1 >= reached
    end = (
        F.when(tail["whole"], F.length(target) + 1 == tail["start"])
        .when(tail["last"].isNull(), F.lit(True))
        .otherwise(F.endswith(target, tail["last"]) & room)
    )
    return (reached > 0) & end


def _pieces(path: Column) -> Column:
    open_path = F.when(
        F.endswith(path, F.lit("$")), F.substring(path, F.lit(1), F.length(path) - 1)
    ).otherwise(path)
    return F.split(open_path, r"\*")
