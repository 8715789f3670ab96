import io
import json
import re
import tarfile
import warnings

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from releaselake.operators import attest, files
from releaselake.sources import readers, writers


def test_readers_keep_order_and_defaults(spark, tmp_path):
    (tmp_path / "rows").mkdir()
    lines = [{"vers": "1.0.0", "cksum": "a", "yanked": False, "features": {"f": []}, "deps": [{"name": "serde", "req": "^1"}]}, {"vers": "1.0.1", "cksum": "b"}]
    (tmp_path / "rows/pk").write_text("\n\n".join(json.dumps(x) for x in lines) + "\n")
    got = readers.registry_rows(spark, str(tmp_path / "rows")).orderBy("ord").collect()
    assert [(r.package, r.vers, r.ord) for r in got] == [("pk", "1.0.0", 0), ("pk", "1.0.1", 2)] and got[0].deps[0].kind is None and got[1].features is None
    (tmp_path / "api").mkdir()
    (tmp_path / "api/pk.json").write_text(json.dumps({"crate": {"repository": "r", "description": None}, "versions": [{"num": "1.0.0", "rust_version": "1.1"}, {"num": "1.0.0", "rust_version": "1.2"}]}))
    assert [(r.package, r.rust_version) for r in readers.api_versions(spark, str(tmp_path / "api")).collect()] == [("pk", "1.2")]
    assert readers.api_packages(spark, str(tmp_path / "api")).first().repository == "r"


def test_index_round_trip_and_missing_files(spark, tmp_path):
    assert readers.corpus_index(spark, str(tmp_path / "none.json")).count() == 0 and readers.curated(spark, str(tmp_path / "none.json"), "notes").count() == 0
    index = {"schema": "v1", "providers": [{"id": "p", "package": "pk", "sources": [{"kind": "registry-index", "releases": [{"id": v, "meta": {"cksum": c, "yanked": False}, "artifact": {"blob": f"b/{v}"}} for v, c in (("1", "x"), ("2", "y"), ("1", "z"))]}]}]}
    (tmp_path / "index.json").write_text(json.dumps(index))
    flat = readers.corpus_index(spark, str(tmp_path / "index.json"))
    assert sorted((r.id, r.cksum, r.blob) for r in flat.collect()) == [("1", "z", "b/1"), ("2", "y", "b/2")]
    writers.write_index(flat, str(tmp_path / "out"))
    line = json.loads(spark.read.text(str(tmp_path / "out")).first().value)
    assert line["schema"] == "index.v1" and line["providers"][0]["id"] == "p" and [r["id"] for r in line["providers"][0]["sources"][0]["releases"]] == ["2", "1"]
    assert line["providers"][0]["sources"][0]["releases"][1]["meta"]["yanked"] is False and list(line) == sorted(line)
    again = readers.corpus_index(spark, str(tmp_path / "out"))
    assert sorted((r.id, r.cksum, r.blob) for r in again.collect()) == [("1", "z", "b/1"), ("2", "y", "b/2")]


def test_surfaces_and_curated_sections(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"rows": [{"package": "p", "vers": "1", "surface": None}, {"package": "q", "vers": "1", "surface": [{"key": "fn:a"}, {"key": "fn:b", "digest": "d", "cfg": ["g"]}]}]}))
    s = readers.analysis_surfaces(spark, str(tmp_path / "a.json"))
    assert {r.package: len(r.surface) for r in s.collect()} == {"p": 0, "q": 2}
    assert [(r.pos, r.digest, r.cfg) for r in readers.surface_items(s).orderBy("pos").collect()] == [(0, "", []), (1, "d", ["g"])]
    (tmp_path / "c.json").write_text(json.dumps({"companions": {"a": {"package": "x", "pin": "mirror"}, "b": {"package": "y", "pin": {"fixed": "0.1.0"}}}}))
    got = {r.provider_id: (r.pin_kind, r.pin_fixed) for r in readers.companions(readers.curated(spark, str(tmp_path / "c.json"), "companions")).collect()}
    assert got == {"a": ("mirror", None), "b": ("fixed", "0.1.0")}


def test_entries_are_usable_by_their_own_environment(spark, tmp_path):
    here = spark.createDataFrame([("t", "r", "d")], "tool string, rustc string, rustdoc string")
    doc = "struct<sha256:string,schema:string>"
    kinds = f"package string, vers string, cksum string, lock string, floor string, tvm {doc}, eac {doc}"
    rows = spark.createDataFrame([("p", "1", "c", "l", None, ("s", "v1"), None), ("a", "1/x", "c", None, "1.85", None, None)], kinds)
    old = spark.createDataFrame([("q", "1", "c", None, None, None, None)], kinds)
    writers.write_attestations(rows, str(tmp_path / "out/part=0"), here)
    writers.write_attestations(old, str(tmp_path / "out/part=1"), here.withColumn("rustc", F.lit("older")))
    entries = readers.attestation_index(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, entries.drop("schema", "environment").collect()), key=str) == sorted(map(tuple, rows.union(old).collect()), key=str)
    usable = lambda now, schema="attestations.v1": {r.package for r in attest.usable_entries(entries, now, schema).collect()}
    assert usable(here) == {"a", "p"} and usable(here.withColumn("rustc", F.lit("older"))) == {"q"} and usable(here, None) == {"a", "p"}
    assert not usable(here, "v0") and not usable(here.withColumn("rustdoc", F.lit("x"))) and not usable(here.withColumn("tool", F.lit(None).cast("string"))) and not usable(here.where("false"))
    assert set(attest.usable_entries(entries, here).columns) == set(rows.columns)
    assert readers.attestation_index(spark, str(tmp_path / "none")).count() == 0


INDEXED = {"schema": "v1", "providers": [{"id": "p", "package": "pk", "sources": [{"kind": "registry-index", "releases": [{"id": "1", "meta": {"cksum": "x"}, "artifact": {"blob": "b"}}]}]}]}


@pytest.mark.parametrize("indent", [None, 1, 4])
def test_an_index_is_read_however_it_is_laid_out(spark, tmp_path, indent):
    (tmp_path / "i.json").write_text("\n" + json.dumps(INDEXED, indent=indent) + "\n\n")
    assert [(r.provider_id, r.id, r.blob) for r in readers.corpus_index(spark, str(tmp_path / "i.json")).collect()] == [("p", "1", "b")]
    assert [r.package for r in readers.index_providers(spark, str(tmp_path / "i.json")).collect()] == ["pk"]


@pytest.mark.parametrize("text", ["{", "not json", json.dumps(INDEXED) + '\n{"providers": [', json.dumps(INDEXED, indent=1)[:-4], "[1"])
def test_a_broken_index_is_empty_as_a_whole_and_says_so(spark, tmp_path, text):
    (tmp_path / "i.json").write_text(text)
    with pytest.warns(UserWarning, match="unreadable"):
        assert readers.corpus_index(spark, str(tmp_path / "i.json")).count() == 0
    with pytest.warns(UserWarning, match="unreadable"):
        assert readers.attestation_index(spark, str(tmp_path / "i.json")).count() == 0


def test_no_index_is_empty_without_a_word(spark, tmp_path):
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        assert readers.corpus_index(spark, str(tmp_path / "none.json")).count() == 0
        (tmp_path / "empty.json").write_text("")
        assert readers.corpus_index(spark, str(tmp_path / "empty.json")).count() == 0


MEMBER = "package string, vers string, path string, mode int, content binary"


def blobs_of(spark, **paths):
    members = [(p, "1", path, 0o644, bytearray(b"x")) for p, names in paths.items() for path in names]
    return files.packed(spark.createDataFrame(members, MEMBER))


@pytest.mark.parametrize(
    "paths, reason",
    [
        (["t/Cargo.toml", "t/src/../../../etc/passwd"], "unsafe path t/src/../../../etc/passwd"), (["t/Cargo.toml", "/t/src/x"], "unsafe path /t/src/x"), (["t/src/a.rs"], "no manifest"),
        (["t/Cargo.toml", "t/src/../../up"], "unsafe path t/src/../../up"), (["Cargo.toml"], "no manifest"), (["t/sub/Cargo.toml"], "no manifest"), (["t/Cargo.toml", "t/src/a/../b.rs"], None),
    ],
)
def test_an_extraction_refuses_hostile_blobs(spark, paths, reason):
    blobs = blobs_of(spark, good=["t/Cargo.toml", "t/src/lib.rs"], other=paths)
    assert {(r.package, r.reason) for r in files.refused(blobs).collect()} == ({("other", reason)} if reason else set())
    releases = blobs.select(F.lit("f").alias("provider_id"), "package", "vers", F.lit("b").alias("blob"))
    measured = spark.createDataFrame([("f",)], "id string")
    counts = Observation()
    members = files.extracted(measured, releases, blobs, counts)
    if not reason:
        assert len(members.collect()) == 4 and counts.get == {"blobs": 2, "members": 4}
        return
    with pytest.raises(Exception, match=re.escape(reason)):
        members.collect()
    with pytest.raises(Exception, match=re.escape(reason)):  # neither fewer columns nor a filter lets it through
        members.where("path like '%.rs'").select("package").write.format("noop").mode("overwrite").save()
    fine = files.extracted(measured, releases.where("package = 'good'"), blobs)
    assert {r.path for r in files.source_members(fine).collect()} == {"Cargo.toml", "src/lib.rs"}


def test_a_blob_without_members_is_refused(spark):
    buffer = io.BytesIO()
    tarfile.open(fileobj=buffer, mode="w:gz").close()
    empty = spark.createDataFrame([("p", "1", bytearray(buffer.getvalue()))], "package string, vers string, content binary")
    assert [tuple(r) for r in files.refused(empty).collect()] == [("p", "1", "no manifest")]
    with pytest.raises(Exception, match="unsafe path src/../../x"):
        files.source_members(spark.createDataFrame([("p", "1", "t/src/../../x", 0o644, bytearray(b""))], MEMBER)).collect()


def test_attestation_docs_and_blobs(spark, tmp_path):
    for kind, text in (("tvm", '{"schema": "v1"}'), ("eac", "not json")):
        (tmp_path / kind / "p").mkdir(parents=True)
        (tmp_path / kind / "p" / "1.0.0.json").write_text(text)
    got = {r.kind: (r.package, r.vers, r.schema, len(r.sha256)) for r in readers.attestation_docs(spark, str(tmp_path)).collect()}
    assert got == {"tvm": ("p", "1.0.0", "v1", 64), "eac": ("p", "1.0.0", None, 64)}
    spark.createDataFrame([("tvm", "p", "2.0.0", "v1"), ("eac", "p", "2.0.0", None)], "kind string, package string, vers string, schema string").write.partitionBy("kind", "package", "vers").json(str(tmp_path / "many"))
    assert {(r.kind, r.package, r.vers, r.schema) for r in readers.attestation_docs(spark, str(tmp_path / "many")).collect()} == {("tvm", "p", "2.0.0", "v1"), ("eac", "p", "2.0.0", None)}
    texts = [("tvm", "p", "1.0.0", '{"schema": "v1"}'), ("eac", "p", "1.0.0", "not json")]
    spark.createDataFrame(texts, readers.ARCHIVED).coalesce(1).write.json(str(tmp_path / "archive"))
    assert {tuple(r) for r in readers.attestation_archive(spark, str(tmp_path / "archive")).collect()} == {tuple(r) for k in ("tvm", "eac") for r in readers.attestation_docs(spark, str(tmp_path / k)).collect()}
    members = spark.createDataFrame([("p", "1.0.0", "top/src/b.rs", 0o644, bytearray(b"b")), ("p", "1.0.0", "top/Cargo.toml", 0o644, bytearray(b"a"))], "package string, vers string, path string, mode int, content binary")
    blob, other = (bytes(files.packed(m).first().content) for m in (members, members.orderBy("path")))
    assert blob == other
    (tmp_path / "s" / "p").mkdir(parents=True)
    (tmp_path / "s" / "p" / "1.0.0.tar.gz").write_bytes(blob)
    blobs = readers.release_blobs(spark, str(tmp_path / "s"))
    assert sorted((r.package, r.vers, r.path, bytes(r.content)) for r in files.unpacked(blobs).collect()) == [("p", "1.0.0", "top/Cargo.toml", b"a"), ("p", "1.0.0", "top/src/b.rs", b"b")]
    releases = spark.createDataFrame([("f", "p", "1.0.0", "x"), ("g", "p", "1.0.0", None)], "provider_id string, package string, vers string, blob string")
    one = lambda i: files.extracted(spark.createDataFrame([(i,)], "id string"), releases, blobs).count()
    assert (one("f"), one("g")) == (2, 0)


def test_provider_config_reads_in_order(spark, tmp_path):
    providers = [{"id": "b", "package": "pb", "sources": [{"kind": "registry-index"}], "surface_source": {"kind": "reexports", "from": ["a"]}}, {"id": "a", "package": "pa", "role": "dependency", "for": "b", "exclude": ["1.0.0"], "sources": [{"kind": "registry-index"}]}]
    (tmp_path / "c.json").write_text(json.dumps({"recommended_provider": "b", "providers": providers}, indent=1))
    got = readers.provider_config(spark, str(tmp_path / "c.json")).orderBy("ord").collect()
    assert [(r.id, r.served_id, r.is_facade, r.surface_from, r.exclude) for r in got] == [("b", None, True, ["a"], None), ("a", "b", False, None, ["1.0.0"])]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"contract": {"id": c}, "providers": providers}) for c in "xy"))
    assert sorted((r.contract_id, r.ord, r.id) for r in readers.provider_config(spark, str(tmp_path / "lines.json"), multi_line=False).collect()) == [(c, i, p) for c in "xy" for i, p in enumerate("ba")]


def test_canonical_json_orders_every_level(spark):
    df = spark.createDataFrame([(({"b": 1, "a": None}, None, [("y", 1)]),)], "z struct<m:map<string,int>,a:struct<q:int>,l:array<struct<t:string,s:int>>>")
    assert writers.canonical_json(df).first().json == '{"z":{"a":null,"l":[{"s":1,"t":"y"}],"m":{"a":null,"b":1}}}'
