"""Bitmaps of releases, sketches, bucketed tables, published differences and gated rules."""

import json
import random

import pytest
from pyspark.sql import functions as F

from releaselake.operators import analyze, attest, bits, curation, index
from releaselake.sources import published, writers
from releaselake.sources.buckets import bucketed

ITEM = "package string, vers string, key string, digest string, cfg array<string>"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def history(spark):
    """Packages of 1, 3, 64, 65 and 150 releases, so that words begin, end and are crossed; pre-releases and two-digit numbers among them."""
    rng, rows = random.Random(1), []
    for p, count in (("one", 1), ("three", 3), ("full", 64), ("over", 65), ("long", 150)):
        versions = [f"1.{i // 3}.0" if i % 3 == 0 else f"1.{i // 3}.{i % 3}" + ("-rc.1" if i % 5 == 4 else "") for i in range(count)]
        state = {}
        for v in versions:
            for k in range(12):
                if rng.random() < 0.15:
                    state.pop(k, None) if k in state else state.update({k: ["d0", []]})
                if k in state and rng.random() < 0.05:
                    state[k] = [f"d{rng.randrange(3)}", state[k][1]]
                if k in state and rng.random() < 0.05:
                    state[k] = [state[k][0], rng.choice([[], ["g"], ["g", "h"]])]
            rows += [(p, v, f"fn:k{k}", d, c) for k, (d, c) in state.items()] + [(p, v, "fn:always", "d", [])]
    return spark.createDataFrame(rows, ITEM).repartition(4).cache()


def test_bits_equal_joins_of_releases(history):
    releases = history.select("package", "vers").distinct()
    delta = analyze.release_delta(history, releases)
    assert rows_of(bits.release_delta(history, releases)) == rows_of(delta) and delta.select("change").distinct().count() == 4
    assert rows_of(bits.first_removed(history, releases)) == rows_of(analyze.first_removed(delta))


def test_used_symbols_by_bits(spark, history):
    items = history.drop("cfg")
    used = spark.createDataFrame([(p, f"fn:k{k}") for p in ("one", "three", "full", "over", "long") for k in range(0, 12, 3)] + [("long", "fn:always"), ("full", "fn:none")], "package string, key string")
    for vers in ("1.0.0", "1.20.0", "9.9.9"):
        baseline = items.select("package", F.lit(vers).alias("vers")).distinct()
        want = analyze.used_api_report(used, items, baseline)
        assert rows_of(bits.used_api_report(used, items, baseline)) == rows_of(want)
    always = used.where("key = 'fn:always'")
    assert {r.compatible for r in bits.used_api_report(always, items, items.select("package", F.lit("1.0.0").alias("vers")).distinct()).collect()} == {True}


def test_trait_breaks_with_planted_ones(spark):
    """A release whose surface is equal but lost traits; one that gained some; one whose surface moved too."""
    kinds = "package string, vers string, api_hash string, traits array<string>"
    rows = [("p", "1.0.0", "h", ["A: Send", "A: Sync"]), ("p", "1.1.0", "h", ["A: Send"]), ("p", "1.2.0", "h", ["A: Send", "B: Sync"]), ("p", "1.10.0", "i", []), ("q", "1.0.0", "h", ["A: Send"]), ("q", "2.0.0-rc.1", "h", []), ("q", "2.0.0", "h", [])]
    assert rows_of(analyze.trait_breaks(spark.createDataFrame(rows, kinds))) == [("p", "1.1.0", ["A: Sync"]), ("q", "2.0.0-rc.1", ["A: Send"])]


def test_sketches_merge_within_their_error(spark):
    deps = spark.range(200_000).select((F.col("id") % 4).alias("batch"), F.concat(F.lit("n"), F.col("id") % 30_011).alias("name"), (F.col("id") % 3).cast("string").alias("req"), F.concat(F.lit("p"), F.col("id") % 977).alias("package"), F.lit("1").alias("vers"))
    sketches = analyze.dependency_sketches(deps, ["batch"])
    got = analyze.sketched_stats(analyze.merged_sketches(sketches)).first()
    assert got.edges == 200_000 and abs(got.names / 30_011 - 1) < 0.03 and abs(got.requirements / 90_033 - 1) < 0.03 and abs(got.dependents / 977 - 1) < 0.03
    early, late = (sketches.where(c) for c in ("batch < 2", "batch >= 2"))
    twice = analyze.merged_sketches(analyze.merged_sketches(early).unionByName(analyze.merged_sketches(late)))
    assert tuple(analyze.sketched_stats(twice).first()) == tuple(got)
    assert analyze.sketched_stats(analyze.merged_sketches(sketches, ["batch"])).count() == 4


def test_bucketed_tables_join_without_an_exchange(spark):
    kinds = "provider_id string, kind string, id string, package string, cksum string"
    releases = spark.createDataFrame([(f"p{i % 7}", "k", str(i), "pk", f"c{i}") for i in range(200)], kinds)
    prior = releases.where("id % 2 = 0").select("provider_id", "kind", "id", "cksum", F.concat(F.lit("b/"), "id").alias("blob"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.classify(bucketed(releases, index.RELEASE, 4), bucketed(prior, index.RELEASE, 4))
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in text and "Exchange" not in text
        assert "Exchange" in index.classify(releases, prior)._jdf.queryExecution().executedPlan().toString()
        assert rows_of(plan) == rows_of(index.classify(releases, prior))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


LINES = "id string, json string"


def test_only_what_moved_is_written(spark, tmp_path):
    path, ids = str(tmp_path / "out"), [f"p{i}" for i in range(300)]
    put = lambda rows: rows_of(published.publish(spark.createDataFrame(rows, LINES), path))
    held = {i: "{}" for i in ids}
    assert put(list(held.items())) == [(i, "new") for i in sorted(ids)] and published.version(spark, path) == 1
    assert put(list(held.items())) == [] and published.version(spark, path) == 1
    held |= {"p7": '{"a":1}', "x": "{}"}
    del held["p9"]
    assert put(list(held.items())) == [("p7", "changed"), ("p9", "vanished"), ("x", "new")]
    assert spark.read.parquet(f"{path}/lines/2").count() == 2
    got = {r.id: (r.json, r.version) for r in published.published(spark, path).collect()}
    assert {i: j for i, (j, _) in got.items()} == held and {i for i, (_, v) in got.items() if v == 2} == {"p7", "x"}
    assert {r.id for r in published.published(spark, path, 1).collect()} == set(ids)
    held["p9"], held["p7"] = "{}", "{}"
    assert put(list(held.items())) == [("p7", "changed"), ("p9", "new")] and {r.id: r.json for r in published.published(spark, path).collect()} == held
    assert put([]) == [(i, "vanished") for i in sorted(held)] and published.published(spark, path).count() == 0


def test_a_publication_that_stops_half_way_does_not_count(spark, tmp_path):
    path = str(tmp_path / "out")
    published.publish(spark.createDataFrame([("a", "1"), ("b", "1")], LINES), path)
    published.publish(spark.createDataFrame([("a", "2"), ("b", "1")], LINES), path)
    (tmp_path / "out/leaves/2/_SUCCESS").unlink()
    assert {r.id: r.json for r in published.published(spark, path).collect()} == {"a": "1", "b": "1"}
    assert rows_of(published.publish(spark.createDataFrame([("a", "3"), ("b", "1")], LINES), path)) == [("a", "changed")]
    assert {r.id: r.json for r in published.published(spark, path).collect()} == {"a": "3", "b": "1"}


def test_trees_are_compared_from_the_root_down(spark):
    lines = spark.createDataFrame([(f"p{i}", str(i)) for i in range(500)], LINES)
    other = lines.withColumn("json", F.when(F.col("id").isin("p3", "p4"), "x").otherwise(F.col("json")))
    a, b = published.leaves(lines), published.leaves(other)
    buckets = published.differing(published.nodes(a), published.nodes(b))
    assert sorted(buckets) == sorted(r.bucket for r in a.where("id in ('p3', 'p4')").select("bucket").distinct().collect())
    assert published.differing(published.nodes(a), published.nodes(a.repartition(5))) == []
    assert rows_of(published.moved(a, b, buckets)) == [("p3", "changed"), ("p4", "changed")]


def test_index_lines_are_those_of_the_written_index(spark, tmp_path):
    rows = spark.createDataFrame([("b", "k", 0, "1", "c1", "b/1"), ("a", "k", 1, "2", None, None), ("a", "k", 0, "1", "c", "b/2")], "provider_id string, kind string, ord int, id string, cksum string, blob string")
    writers.write_index(rows, str(tmp_path / "i"))
    assert [r.value for r in spark.read.text(str(tmp_path / "i")).collect()] == [r.json for r in writers.index_lines(rows).orderBy("id").collect()]
    assert json.loads(writers.index_lines(rows).where("id = 'a'").first().json)["providers"][0]["sources"][0]["releases"][1]["artifact"] is None


def test_the_last_of_equal_toolchains_counts(spark):
    lines = spark.createDataFrame([(0, "1.85-x86_64-linux"), (1, "stable-x86_64-linux"), (2, "1.85.0-x86_64-linux (default)"), (3, "1.90.1-aarch64"), (4, "nonsense")], "ord int, line string")
    assert rows_of(attest.installed_toolchains(lines.repartition(3))) == [("1.85.0", "1.85.0"), ("1.90.1", "1.90.1")]


def test_rules_apply_behind_gates_that_are_on(spark):
    rules = spark.createDataFrame([(str(i), "fn:a", k, "p", "1", "h", "p", "2", "i", True) for i, k in enumerate(("fn:b", "fn:c", "fn:d"))], "id string, from_key string, to_key string, from_provider string, from_version string, from_hash string, to_provider string, to_version string, to_hash string, human_confirmed boolean")
    versions = spark.createDataFrame([("p", "1", "h"), ("p", "2", "i")], "provider_id string, vers string, api_hash string")
    items = spark.createDataFrame([("p", "1", "fn:a", []), ("p", "2", "fn:b", ["x"]), ("p", "2", "fn:c", ["x", "y"]), ("p", "2", "fn:d", [])], "provider_id string, vers string, key string, cfg array<string>")
    status = lambda *on: [r.status for r in curation.rule_check(rules, versions, items, spark.createDataFrame([(g,) for g in on], "gate string")).orderBy("id").collect()]
    assert status() == ["gated", "gated", "applies"] and status("x") == ["applies", "gated", "applies"] and status("y", "x", "z") == ["applies"] * 3
