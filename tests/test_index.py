import pytest
from pyspark.sql import functions as F

from releaselake.operators import dataset, files, index, validate

REL = "provider_id string, kind string, id string, package string, cksum string"
PRIOR = "provider_id string, kind string, id string, cksum string, blob string"


def test_classify_fresh_moved_missing_and_null_digests(spark):
    rel = spark.createDataFrame([("p", "k", v, "pk", c) for v, c in (("1", "a"), ("2", "b"), ("3", None), ("4", "d"), ("5", "e"))], REL)
    prior = spark.createDataFrame([("p", "k", "1", "a", "B1"), ("p", "k", "2", "x", "B2"), ("p", "k", "3", None, "B3"), ("p", "k", "4", "d", None)], PRIOR)
    got = {r.id: (r.status, r.blob) for r in index.classify(rel, prior).collect()}
    assert got == {"1": ("reused", "B1"), "2": ("new", None), "3": ("reused", "B3"), "4": ("new", None), "5": ("new", None)}
    forced = index.forced_releases(spark.createDataFrame([("pk@1",), ("bad",)], "spec string"))
    assert {r.id for r in index.classify(rel, prior, forced).where("status = 'reused'").collect()} == {"3"}
    plan = {r.id: r.status for r in index.classify(rel, prior, forced, dry_run=True).collect()}
    assert plan["1"] == "reuse" and plan["2"] == "would fetch"


def test_second_sync_is_all_reused(spark):
    rel = spark.createDataFrame([("p", "k", str(i), "pk", f"c{i}") for i in range(20)], REL)
    first = index.classify(rel, spark.createDataFrame([], PRIOR))
    done = first.select("provider_id", "kind", "id", "cksum", F.concat(F.lit("b/"), "id").alias("blob"))
    assert index.classify(rel, done).where("status <> 'reused'").count() == 0


def test_registry_meta_defaults(spark):
    dep = "struct<name:string,req:string,optional:boolean,default_features:boolean,kind:string>"
    rows = spark.createDataFrame([("p", "1.0.0", "aaa", None, {"f": [], "a": ["f"]}, [("serde", "^1", None, None, None)]), ("p", "1.0.1", "bbb", True, None, None)], f"package string, vers string, cksum string, yanked boolean, features map<string,array<string>>, deps array<{dep}>")
    api = spark.createDataFrame([("p", "1.0.0", "1.82", "2026-01-02T03:04:05+00:00"), ("p", "1.0.1", "", None)], "package string, num string, rust_version string, created_at string")
    got = {r.vers: r for r in index.registry_meta(rows, api).collect()}
    assert got["1.0.0"].feature_names == ["a", "f"] and tuple(got["1.0.0"].deps[0]) == ("serde", "^1", False, True, "normal") and got["1.0.0"].yanked is False
    assert got["1.0.1"].rust_version is None and got["1.0.1"].yanked is True and got["1.0.1"].deps == [] and got["1.0.1"].feature_names == []


def test_coverage_stamp_keeps_the_winners_offset(spark):
    rows = spark.createDataFrame([("2026-01-02T03:04:05.678+00:00",), ("2026-01-02T06:04:06.5+02:00",), ("not-a-date",), (None,)], "created_at string")
    assert dataset.coverage_stamp(rows).first().synced_at == "2026-01-02T06:04:06+02:00"
    for given, want in (("2024-05-01T12:00:00.123456Z", "2024-05-01T12:00:00+00:00"), ("2024-05-01 12:00:00+0200", "2024-05-01T12:00:00+02:00"), ("2024-05-01T12:00", "2024-05-01T12:00:00"), ("2024-05-01", "2024-05-01T00:00:00")):
        assert dataset.coverage_stamp(spark.createDataFrame([(given,)], "created_at string")).first().synced_at == want
    later = spark.createDataFrame([("2026-01-02T03:04:05.678+00:00",), ("2026-01-02T06:04:06.5+02:00",)], "created_at string")
    assert dataset.coverage_stamp(later).first().synced_at == "2026-01-02T06:04:06+02:00"
    assert dataset.coverage_stamp(rows.where("created_at = 'not-a-date'")).first().synced_at is None


def config(spark, rows):
    kinds = "ord int, id string, package string, role string, served_id string, sources array<struct<kind:string>>, exclude array<string>, surface_kind string, surface_from array<string>"
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], kinds)


OK = [("registry-index",)]


@pytest.mark.parametrize(
    "row, no",
    [
        (("b", "p", None, None, [], None, None, None), 5), (("b", "p", "wat", None, OK, None, None, None), 2), (("b", "p", None, "ghost", OK, None, None, None), 3), (("a", "p", None, None, OK, None, None, None), 1),
        (("b", "", None, None, OK, None, None, None), 4), (("b", "p", None, None, OK, [None], None, None), 6), (("b", "p", None, None, OK, None, "scan", ["d"]), 7), (("b", "p", None, None, OK, None, "reexports", []), 8),
        (("b", "p", None, None, OK, None, "reexports", ["x"]), 11), (("b", "p", None, None, OK, None, "reexports", ["a"]), 12), (("b", "p", None, None, OK, None, "reexports", ["d"]), 13), (("b", "p", None, None, [("git",)], None, None, None), 14),
    ],
)
def test_config_violations(spark, row, no):
    base = [("a", "p", None, None, OK, ["1.0.0"], "reexports", ["d"]), ("d", "q", "dependency", "a", OK, None, None, None)]
    assert validate.violations(config(spark, base)).count() == 0
    bad = config(spark, [*base, row])
    assert no in [r.check_no for r in validate.violations(bad).collect()]
    with pytest.raises(ValueError):
        validate.require_valid(bad)


def test_first_violation_is_the_first_in_config_order(spark):
    rows = [("zz", "p", None, None, [], None, None, None), ("aa", "p", "wat", None, OK, None, None, None)]
    with pytest.raises(ValueError, match="zz: no sources"):
        validate.require_valid(config(spark, rows))
    with pytest.raises(ValueError, match="aa: duplicate"):
        validate.require_valid(config(spark, [*rows, ("aa", "p", None, None, OK, None, None, None)]))
    sources = [("f", "p", None, None, OK, None, "reexports", ["d", "x", "f"]), ("d", "q", "dependency", "f", OK, None, None, None)]
    with pytest.raises(ValueError, match="unknown provider x"):
        validate.require_valid(config(spark, sources))


def test_merged_index_keeps_config_order(spark):
    synced, carried = spark.createDataFrame([(2, "c"), (0, "a")], "ord int, id string"), spark.createDataFrame([(1, "b", "d")], "ord int, id string, description string")
    assert [r.id for r in index.merged_index(synced, carried).collect()] == ["a", "b", "c"]


def test_member_rules_and_unsafe_paths(spark):
    rows = [("p-1/Cargo.toml", 0o664), ("p-1/src/lib.rs", 0o600), ("p-1/README.md", 0o644), ("p-1/tests/it.rs", 0o644), ("Cargo.toml", 0o644), ("p-1/build.rs", 0o775)]
    m = spark.createDataFrame([("p", "1", *r, bytearray(b"x")) for r in rows], "package string, vers string, path string, mode int, content binary")
    got = {r.path: r.mode for r in files.source_members(m).collect()}
    assert got == {"Cargo.toml": 0o644, "src/lib.rs": 0o644, "build.rs": 0o755}
    assert files.without_manifest(files.source_members(m.where("path like '%lib.rs'"))).count() == 1
    paths = spark.createDataFrame([("a/../b",), ("../evil",), ("/abs",), ("a/../../x",), ("ok/./y",)], "path string")
    assert [r.path for r in paths.where(files.is_unsafe(F.col("path"))).collect()] == ["../evil", "/abs", "a/../../x"]


def test_unpack_and_verify(spark):
    import hashlib
    import io
    import tarfile

    buffer = io.BytesIO()
    with tarfile.open(fileobj=buffer, mode="w:gz") as tar:
        for name in ("p-1/Cargo.toml", "p-1/src/lib.rs"):
            info = tarfile.TarInfo(name)
            info.size = 2
            tar.addfile(info, io.BytesIO(b"ab"))
    data = buffer.getvalue()
    blobs = spark.createDataFrame([("p", "1", bytearray(data))], "package string, vers string, content binary")
    assert sorted(r.path for r in files.source_members(files.unpacked(blobs)).collect()) == ["Cargo.toml", "src/lib.rs"]
    good = hashlib.sha256(data).hexdigest()
    rel = spark.createDataFrame([("p", "1", good), ("p", "2", "x"), ("q", "1", None)], "package string, vers string, cksum string")
    states = {(r.package, r.vers): (r.state, r.reason) for r in files.verified(rel, blobs.union(blobs.withColumn("package", F.lit("q")))).collect()}
    assert states == {("p", "1"): ("built", None), ("p", "2"): ("failed", "missing"), ("q", "1"): ("built", None)}
    assert files.verified(rel.withColumn("cksum", F.lit("deadbeef")), blobs).where("vers = '1' and package = 'p'").first().reason == "mismatch"
