import pytest
from pyspark.sql import functions as F

from releaselake.functions import items, versions


def one(spark, value, column, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize(
    "given, want",
    [("1.85", "1.85.0"), ("1.85.0", "1.85.0"), (" 1.85 ", "1.85.0"), ("1", "1.0.0"), (None, None), ("", None), ("not-a-version", None), ("1.98.2-rc.1", None), ("1.2.3.4", None)],
)
def test_padded(spark, given, want):
    assert one(spark, given, versions.padded) == want


def test_plain_key_drops_suffixes(spark):
    assert one(spark, "1.98.1-nightly+x", versions.plain_key) == [1, 98, 1]
    assert one(spark, "stable", versions.plain_key) is None


def test_semver_order(spark):
    order = ["1.0.0-alpha", "1.0.0-alpha.1", "1.0.0-alpha.beta", "1.0.0-beta.2", "1.0.0-beta.11", "1.0.0-rc.1", "1.0.0", "1.2.0", "1.10.0"]
    df = spark.createDataFrame([(v,) for v in reversed(order)], "v string")
    assert [r.v for r in df.orderBy(versions.semver_key(F.col("v"))).collect()] == order
    assert one(spark, "1.0", versions.semver_key) is None


@pytest.mark.parametrize(
    "line, want", [("rustc 1.98.1 (abc 2026-01-01)", "1.98.1"), ("rustc 1.99.0-nightly (abc)", "1.99.0-nightly"), ("1.97.0, x", "1.97.0"), ("not rustc", None), ("", None)]
)
def test_compiler_version(spark, line, want):
    assert one(spark, line, versions.compiler_version) == want


@pytest.mark.parametrize("line, want", [("1.85-x86_64-unknown-linux-gnu", ("1.85.0", "1.85")), ("1.97.0-x86_64-unknown-linux-gnu (default)", ("1.97.0", "1.97.0")), ("stable-x86_64-unknown-linux-gnu", None), ("1.85", None)])
def test_installed_toolchain(spark, line, want):
    got = one(spark, line, versions.installed_toolchain)
    assert (got and tuple(got)) == want


@pytest.mark.parametrize("package, want", [("a", "1/a"), ("AB", "2/ab"), ("abc", "3/a/abc"), ("Serde", "se/rd/serde")])
def test_sparse_path(spark, package, want):
    assert one(spark, package, items.sparse_path) == want


def test_names_and_keys(spark):
    df = spark.createDataFrame([("fn:a::b::c", "a::b", "z"), ("plain", "", None), ("enum:m::X", "m", "_")], "key string, target string, alias string")
    got = df.select(items.item_kind(F.col("key")).alias("k"), items.item_name(F.col("key")).alias("n"), items.renamed(F.col("key"), F.col("target"), F.col("alias")).alias("r"), items.name_prefixes(items.item_name(F.col("key"))).alias("p"), items.name_prefixes(items.item_name(F.col("key")), True).alias("q")).collect()
    assert [tuple(r) for r in got] == [
        ("fn", "a::b::c", "fn:z::c", ["a", "a::b", "a::b::c"], ["a", "a::b"]),
        ("plain", "plain", "plain", ["plain"], []),
        ("enum", "m::X", "enum:m::X", ["m", "m::X"], ["m"]),
    ]
    lib = spark.createDataFrame([("", "a-b"), (None, "a-b"), ("own", "a-b")], "d string, p string").select(items.library_name(F.col("d"), F.col("p")).alias("l"))
    assert [r.l for r in lib.collect()] == ["a_b", "a_b", "own"]


def test_surface_hash_ignores_order_and_moves_with_any_item(spark):
    rows = [("fn:a", "1", ["g"]), ("fn:b", "2", []), ("fn:c", None, None)]

    def h(rs, parts):
        return spark.createDataFrame(rs, "k string, d string, c array<string>").repartition(parts).agg(items.surface_hash(F.col("k"), F.col("d"), F.col("c")).alias("h")).first().h

    assert h(rows, 1) == h(rows[::-1], 3)
    import hashlib

    want = "\0".join(["fn:a\0" + "1\0g", "fn:b\0" + "2\0", "fn:c\0\0"])
    assert h(rows, 2) == hashlib.sha256(want.encode()).hexdigest()
    assert h(rows, 1) != h([("fn:a", "1", []), *rows[1:]], 1)
