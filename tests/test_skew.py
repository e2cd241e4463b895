import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from webloom.operators.skew import hot_keys, join_skewed, numbered, salted


@pytest.fixture(scope="module")
def big(spark):
    """One key holds more than half of the rows; one key is missing on the right."""
    key = F.when(F.col("id") % 5 < 3, "hot").when(F.col("id") % 5 == 3, "gone").otherwise(
        F.concat(F.lit("k"), F.col("id") % 7)
    )
    nulls = F.when(F.col("id") % 50 != 4, key)
    return spark.range(500).select(nulls.alias("key"), F.col("id").alias("n"), (F.col("id") / 3).alias("x"))


@pytest.fixture(scope="module")
def small(spark):
    keys = [("hot", 1), *[(f"k{i}", i) for i in range(7)], ("other", 9)]
    return spark.createDataFrame(keys, "key string, v int")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("min_rows", [1, 50, 10_000])
def test_salted_join_equals_plain_join(big, small, how, min_rows):
    found = join_skewed(big, small, ["key"], how, min_rows=min_rows)
    plain = big.join(small, "key", how)
    assert found.columns == plain.columns
    assert rows(found) == rows(plain)


def test_hot_key_is_spread(big, small):
    hot = hot_keys(big, ["key"], 100)
    assert [r.key for r in hot.collect()] == ["hot", "gone"] or "hot" in {r.key for r in hot.collect()}
    plan = join_skewed(big, small, ["key"], hot=hot)._jdf.queryExecution().toString()
    assert "_salt" in plan


def test_salt_ignores_doubles(big, small):
    plan = join_skewed(big, small, ["key"], min_rows=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(key" in plan and "x#" not in plan.split("xxhash64(")[1].split(")")[0]


def test_other_joins_are_refused(big, small):
    with pytest.raises(ValueError):
        join_skewed(big, small, ["key"], "full")


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_numbered_equals_row_number(big, partitions):
    ranked = big.withColumn("seq", F.col("n") % 40)
    found = numbered(ranked, ["seq", "n"], "no", ["key"], partitions)
    plain = ranked.withColumn("no", F.row_number().over(Window.partitionBy("key").orderBy("seq", "n")))
    assert rows(found, "key", "n", "no") == rows(plain, "key", "n", "no")


def test_numbered_over_all_rows(big):
    ranked = big.withColumn("level", F.concat(F.lit("l"), F.col("n") % 3))
    found = numbered(ranked, ["level", "n"], "no", partitions=5)
    order = Window.partitionBy(F.lit(1)).orderBy("level", "n")
    assert rows(found, "n", "no") == rows(ranked.withColumn("no", F.row_number().over(order)), "n", "no")


def test_numbered_splits_equal_values(big):
    """One group with one value of the first order column still spreads over many ranges."""
    ranked = big.select(F.lit("g").alias("g"), F.lit(1).alias("seq"), "n")
    plan = numbered(ranked, ["seq", "n"], "no", ["g"], partitions=10)
    assert sorted(r["no"] for r in plan.collect()) == list(range(1, 501))
    sizes = ranked.repartitionByRange(10, "g", "seq", "n").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in sizes.collect()) < 100


def test_numbered_empty(big):
    assert numbered(big.where("n < 0"), ["n"], "no", ["key"]).collect() == []


def test_null_and_hot_keys_are_split(spark):
    """No part holds more than twice the target, with 60 % of null keys or one key of many targets."""
    nulls = spark.range(3000).select(F.when(F.col("id") % 10 < 4, F.col("id") % 7).alias("key"), "id")
    spread = salted(nulls, ["key"], hot_keys(nulls, ["key"], 10_000))
    assert spread.where("key IS NULL").groupBy("_salt").count().agg(F.max("count")).first()[0] <= 2
    one = spark.range(5000).select(F.lit("k").alias("key"), "id")
    parts = salted(one, ["key"], hot_keys(one, ["key"], 50)).groupBy("_salt").count()
    assert parts.count() > 90 and parts.agg(F.max("count")).first()[0] <= 100


def test_numbered_by_weight(spark):
    rows = [(n % 3, n, (n * 7) % 5 + 1) for n in range(200)]
    table = spark.createDataFrame(rows, "g int, seq int, places int")
    found = {(r["g"], r["seq"]): r["last"] for r in numbered(table, ["seq"], "last", ["g"], 6, "places").collect()}
    want, so_far = {}, {0: 0, 1: 0, 2: 0}
    for g, seq, places in rows:
        so_far[g] += places
        want[g, seq] = so_far[g]
    assert found == want
