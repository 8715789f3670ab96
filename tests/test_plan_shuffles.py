"""What the migration plans shuffle: each item once, however many sides of releases and rules it is on."""

import pytest
from pyspark.sql import functions as F

from releaselake.plans import QUERIES

from .test_plans import both


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """Forty packages of six releases with some eighty items each, of which some keys return unchanged, others do not, and rules apply here and there."""
    at = str(tmp_path_factory.mktemp("many"))
    n = F.col("id")
    rows = spark.range(20_000).select(
        n.alias("l_orderkey"), F.pmod(F.xxhash64(n, F.lit(1)), F.lit(300)).alias("l_partkey"), F.pmod(F.xxhash64(n, F.lit(2)), F.lit(40)).alias("l_suppkey"), (F.pmod(F.xxhash64(n, F.lit(3)), F.lit(7)) + 1).cast("int").alias("l_linenumber"),
        F.pmod(F.xxhash64(n, F.lit(4)), F.lit(2)).cast("double").alias("l_quantity"), F.lit("N").alias("l_returnflag"), F.when(n % 5 == 0, "F").otherwise("O").alias("l_linestatus"),
        F.timestamp_add("QUARTER", F.pmod(F.xxhash64(n, F.lit(5)), F.lit(6)).cast("int"), F.lit("1997-02-10 00:00:00").cast("timestamp")).alias("l_shipdate"),
    )
    rows.coalesce(1).write.parquet(f"{at}/lineitem.parquet")
    spark.range(40).select(n.alias("s_suppkey")).coalesce(1).write.parquet(f"{at}/supplier.parquet")
    return at


def shuffled(spark, df):
    """Bytes that the tasks of a frame wrote for shuffles."""
    sc = spark.sparkContext._jsc.sc()

    def so_far():
        sc.listenerBus().waitUntilEmpty()
        return sum(sc.statusStore().executorList(False).apply(i).totalShuffleWrite() for i in range(sc.statusStore().executorList(False).size()))

    before = so_far()
    df().write.format("noop").mode("overwrite").save()
    return so_far() - before


@pytest.mark.parametrize("name", ["migration_plan", "fork_migration_plans"])
def test_items_are_shuffled_once(spark, many, name):
    got = both(spark, many, name)
    assert {r["action"] for r in got} == {"keep", "rewrite", "manual"}
    once = shuffled(spark, lambda: spark.read.parquet(f"{many}/lineitem.parquet").select(*"l_suppkey l_shipdate l_partkey l_linenumber l_quantity l_linestatus".split()).repartition("l_suppkey"))
    assert shuffled(spark, lambda: QUERIES[name](spark, many)) < 4 * once
