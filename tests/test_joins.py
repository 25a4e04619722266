"""Joins with a third of the rows on one key."""

import pytest
from pyspark.sql import functions as F

from checks.queries import PLANS
from checks.tables import model_tables
from tianguis.operators.joins import Spread, heavy_hashes, heavy_keys, join_beside, spread_join

from helpers import SF_DIR, rows

N = 30_000


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {n: spark.conf.get(n, None) for n in names}
    for n, value in zip(names, ("-1", "-1", "false")):
        spark.conf.set(n, value)
    yield
    for n, value in before.items():
        spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def facts(spark):
    """A third of the rows on key 7, a sixth on NULL, the rest on 1,000 keys, some of which no lookup knows."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 6 == 1, None).otherwise(F.col("id") % 1000)
    return spark.range(N).select(F.lit("E").alias("e"), key.alias("k"), "id")


def lookup(spark):
    return spark.range(900).select(F.lit("E").alias("e"), F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


def test_the_sketch_finds_the_heavy_keys_only(spark):
    df = facts(spark)
    want = {r[0]: r[1] for r in df.groupBy(F.xxhash64("e", "k")).count().filter("count > 1000").collect()}
    got = {r[0]: r[1] for r in heavy_keys(df, ["e", "k"], 200).collect()}
    assert set(got) == set(want) and len(got) == 2
    assert all(abs(got[h] - want[h] / (N / 200)) <= 1 for h in got)
    assert heavy_keys(df.limit(0), ["e", "k"], 200).collect() == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_same_rows_and_columns_as_a_plain_join(spark, no_broadcast, how):
    left, right = facts(spark), lookup(spark).unionByName(lookup(spark).filter("k < 20"))
    plain, spread = left.join(right, ["e", "k"], how), spread_join(left, right, ["e", "k"], how)
    assert spread.columns == plain.columns and rows(spread) == rows(plain)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_hot_key_is_spread_though_one_side_was_summed(spark, no_broadcast, how):
    totals = facts(spark).filter("k IS NOT NULL").groupBy("e", "k").agg(F.count("*").alias("n"))

    def largest(df):
        return max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())

    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        plain, spread = facts(spark).join(totals, ["e", "k"], how), spread_join(facts(spark), totals, ["e", "k"], how)
        assert largest(plain) > N / 3 and largest(spread) < N / 5
        assert rows(spread) == rows(plain)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_sketch_where_the_lookup_is_broadcast(spark):
    plan = spread_join(facts(spark), lookup(spark), ["e", "k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "xxhash64" not in plan


def test_names_in_use_empty_tables_and_refused_kinds(spark, no_broadcast):
    left = facts(spark).withColumnRenamed("id", "_part").withColumn("_Hash", F.lit(1))
    right = lookup(spark).withColumnRenamed("v", "_parts")
    assert rows(spread_join(left, right, ["e", "k"])) == rows(left.join(right, ["e", "k"], "left"))
    assert spread_join(facts(spark).limit(0), right, ["e", "k"]).count() == 0
    assert spread_join(facts(spark), right.limit(0), ["e", "k"]).count() == N
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            spread_join(left, right, ["e", "k"], how)


@pytest.mark.parametrize("name", ["V05_margen_linea_mes", "V13_iscam_ventas_mensual"])
def test_plans_over_large_lookups_with_a_hot_key(spark, name):
    def run():
        t = model_tables(spark, SF_DIR)
        item = t["fact_ventas_articulo"].agg(F.min("ARTICULO_ID")).first()[0]
        customer = t["fact_ventas_articulo"].agg(F.min("CLIENTE_ID")).first()[0]
        hot = F.col("DOCTO_VE_ID") % 3 == 0
        sales = t["fact_ventas_articulo"].withColumn("ARTICULO_ID", F.when(hot, item).otherwise(F.col("ARTICULO_ID")))
        sales = sales.withColumn("CLIENTE_ID", F.when(hot, customer).otherwise(F.col("CLIENTE_ID")))
        df = PLANS[name](t.replacing(fact_ventas_articulo=sales))
        return rows(df.select(*sorted(df.columns))), "xxhash64" in df._jdf.queryExecution().optimizedPlan().toString()

    small, spread = run()
    assert not spread
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        large, spread = run()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert large == small and spread


def test_dealt_rows_stay_where_they_are_and_meet_their_own_company(spark, no_broadcast):
    left = facts(spark).withColumn("e", F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 2 == 0, "F").otherwise("E"))
    twice = lookup(spark).unionByName(lookup(spark).filter("k < 20"))
    right = twice.unionByName(twice.withColumns({"e": F.lit("F"), "v": F.col("v") + 1}))
    plain = rows(left.join(right, ["e", "k"], "left"))
    for partitions in (4, 200):
        (heavy,) = heavy_hashes(left, [["e", "k"]], partitions)
        spread = Spread(["e", "k"], heavy)
        dealt = spread.dealt(left, ["id"]).repartition(*spread.keys[1:])
        joined = join_beside(dealt, spread.copied(right), spread.keys[1:], ["e"])
        assert bool(heavy) == (partitions == 200) and rows(joined, "e", "k", "id", "v") == plain
        shuffles = joined._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_COL")
        assert shuffles == 1


def test_market_sales_are_dealt_once_for_sums_and_labels(spark):
    """wide sums were shuffled by group, and again by item."""
    df = PLANS["V13_iscam_ventas_mensual"](model_tables(spark, SF_DIR))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    at = next(i for i, line in enumerate(final) if "partial_sum(UNIDADES" in line)
    assert "HashAggregate" in final[at - 1] and "Exchange" not in final[at - 1]
    above = [line for line in final[:at] if "Exchange hashpartitioning" in line and "MES" in line]
    assert not above
