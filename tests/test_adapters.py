import json
import os

import pytest
from pyspark.sql import functions as F

from releaselake.sources import adapters

CONFIG = "id string, package string, sources array<struct<kind:string,package:string,index_path:string>>"


def write(folder, path, *versions):
    (folder / path).parent.mkdir(parents=True, exist_ok=True)
    (folder / path).write_text("\n\n".join(json.dumps({"vers": v, "cksum": f"c{v}", "yanked": False}) for v in versions) + "\n")


@pytest.fixture
def registry(tmp_path):
    write(tmp_path / "r", "se/rd/serde", "1.0.0", "1.0.1")
    write(tmp_path / "r", "3/a/abc", "0.1.0")
    write(tmp_path / "r", "odd/place", "9.0.0")
    write(tmp_path / "r", "package=Tokio/part-0.txt", "1.1.0")
    (tmp_path / "r" / "_SUCCESS").write_text("")
    (tmp_path / "r" / ".hidden").write_text("no")
    return tmp_path / "r"


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_sources_are_read_by_their_kind(spark, registry, monkeypatch, scheme):
    monkeypatch.setattr(adapters, "PARTITION_BYTES", 1)
    config = spark.createDataFrame([("p", "serde", [("registry-index", None, None)]), ("q", "x", [("registry-index", "abc", ""), ("registry-index", None, "odd/place")]), ("t", "tokio", [("registry-index", "", None)]), ("n", "none", [("registry-index", None, None)])], CONFIG)
    rows = adapters.read_sources(spark, config, {"registry-index": scheme + str(registry)})
    got = sorted((r.provider_id, r.package, r.ord, r.vers, r.cksum, r.kind) for r in rows.collect())
    k = "registry-index"
    assert got == [("p", "serde", 0, "1.0.0", "c1.0.0", k), ("p", "serde", 2, "1.0.1", "c1.0.1", k), ("q", "abc", 0, "0.1.0", "c0.1.0", k), ("q", "x", 0, "9.0.0", "c9.0.0", k), ("t", "tokio", 0, "1.1.0", "c1.1.0", k)]
    assert spark.read.format(k).option("path", str(registry)).load().rdd.getNumPartitions() == 4


def test_an_unknown_kind_is_an_error_before_anything_is_read(spark):
    config = spark.createDataFrame([("p", "serde", [("registry-index", None, None)]), ("q", "x", [("mirror", None, None)])], CONFIG)
    with pytest.raises(ValueError, match=r"no adapter for source kind mirror \(known: registry-index\)"):
        adapters.read_sources(spark, config, {"registry-index": "/nowhere"})
    assert adapters.read_sources(spark, config.where("false"), {}).count() == 0


def test_another_kind_can_be_added(spark, registry, monkeypatch):
    monkeypatch.setattr(adapters, "ADAPTERS", dict(adapters.ADAPTERS))

    @adapters.adapter("listed")
    def _listed(spark, address, sources):
        return sources.select("provider_id", "package", F.lit(0).alias("ord"), F.lit(address).alias("vers"), *(F.lit(None).cast(t).alias(c) for c, t in (("cksum", "string"), ("yanked", "boolean"), ("features", "map<string,array<string>>"), ("deps", f"array<{adapters.ROW.split('array<', 2)[2][:-1]}>"))))

    config = spark.createDataFrame([("p", "abc", [("registry-index", None, None), ("listed", "z", None)])], CONFIG)
    got = {(r.kind, r.package, r.vers) for r in adapters.read_sources(spark, config, {"registry-index": str(registry), "listed": "7"}).collect()}
    assert got == {("registry-index", "abc", "0.1.0"), ("listed", "z", "7")}


def test_paths_that_a_filter_leaves_out_are_not_opened(spark, registry):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = adapters.IndexReader(str(registry))
    other = GreaterThan(("ord",), 1)
    assert list(reader.pushFilters([In(("index_path",), ("se/rd/serde", "3/a/abc")), other, EqualTo(("index_path",), "3/a/abc")])) == [other]
    assert [p for f in reader.partitions() for p in f.paths] == ["3/a/abc"]
    adapters.registered(spark)
    df = spark.read.format("registry-index").option("path", str(registry)).load().where("index_path = 'se/rd/serde' and ord > 1")
    assert [r.line[:16] for r in df.collect()] == ['{"vers": "1.0.1"'] and df.rdd.getNumPartitions() == 1


def test_files_that_change_are_streamed(spark, registry, tmp_path):
    def run():
        rows = adapters.registry_stream(spark, str(registry)).select("index_path", "vers")
        rows.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(once=True).start().awaitTermination()
        return sorted((r.index_path, r.vers) for r in spark.read.parquet(str(tmp_path / "out")).collect())

    first = run()
    assert first == [("3/a/abc", "0.1.0"), ("odd/place", "9.0.0"), ("se/rd/serde", "1.0.0"), ("se/rd/serde", "1.0.1"), ("to/ki/tokio", "1.1.0")]
    assert run() == first
    write(registry, "3/a/abc", "0.1.0", "0.2.0")
    os.utime(registry / "3/a/abc", (4e9, 4e9))
    assert sorted(set(run()) - set(first)) == [("3/a/abc", "0.2.0")] and len(run()) == len(first) + 2
