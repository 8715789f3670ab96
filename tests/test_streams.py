import pytest
from pyspark.sql import functions as F

from releaselake.plans import QUERIES
from releaselake.streaming import sync

EVENTS = [(1, 10, "a", '{"k": 1}'), (2, 10, "b", '{"k": 2}'), (3, 11, "a", '{"k": 1}'), (5, 10, "z", '{"k": 1}'), (4, 10, "c", '{"k": 1}')]
ROWS = "provider_id string, kind string, id string, package string, cksum string, seq long"


@pytest.mark.parametrize("parts", [0, 3])
def test_stream_sync_takes_in_a_file_or_a_directory(spark, tmp_path, parts):
    df = spark.createDataFrame(EVENTS, "event_id long, user_id long, event_type string, props string")
    if parts:
        df.repartition(parts).write.parquet(f"{tmp_path}/events.parquet")
    else:
        df.toPandas().to_parquet(f"{tmp_path}/events.parquet")
    got = {(r.provider_id, r.id): r.cksum for r in QUERIES["stream_sync"](spark, str(tmp_path)).collect()}
    md5 = {x: spark.range(1).select(F.md5(F.lit(x).cast("binary"))).first()[0] for x in "abz"}
    assert got == {("prov-10", "1.0.0"): md5["z"], ("prov-10", "2.0.0"): md5["b"], ("prov-11", "1.0.0"): md5["a"]}


class Feed:
    """Batches that arrive one by one, each taken in by a stream that starts anew from its checkpoint."""

    def __init__(self, spark, path):
        self.spark, self.path, self.index = spark, path, f"{path}/index"

    def take(self, rows, stream="one"):
        arrived = f"{self.path}/in-{stream}"
        self.spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(arrived)
        sync.run_available(self.spark.readStream.schema(ROWS).parquet(arrived), self.index, f"{self.path}/cp-{stream}").awaitTermination()

    def rows(self):
        return sorted((r.provider_id, r.id, r.cksum) for r in sync.read_index(self.spark, self.index).collect())

    def changed(self):
        """How many rows each batch changed, of those that no compaction took yet."""
        store = sync.Store(self.spark, self.index)
        return [store.read(f"changes/{n}").count() for n in store.numbers()]


def row(provider, vers, cksum, seq):
    return (provider, "k", vers, f"{provider}k", cksum, seq)


def test_one_row_a_release_whatever_batches_say(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    feed.take([row("p", "1", "a", 1), row("q", "1", "b", 2)])
    feed.take([row("p", "1", "z", 3), row("p", "2", "c", 4), row("q", "1", "b", 5)])
    assert feed.rows() == [("p", "1", "z"), ("p", "2", "c"), ("q", "1", "b")]
    feed.take([row("p", "1", "y", 6), row("p", "1", "a", 7), row("r", "1", None, 8)])
    want = [("p", "1", "a"), ("p", "2", "c"), ("q", "1", "b"), ("r", "1", None)]
    assert feed.changed() == [2, 2, 2] and feed.rows() == want
    assert sync.compact(spark, feed.index) == 3 and feed.rows() == want and feed.changed() == []
    feed.take([row("p", "1", "a", 9), row("r", "1", None, 10), row("q", "1", "n", 11)])
    assert feed.changed() == [1] and feed.rows() == [("p", "1", "a"), ("p", "2", "c"), ("q", "1", "n"), ("r", "1", None)]
    assert {r.blob for r in sync.read_index(spark, feed.index).where("provider_id = 'p'").collect()} == {"sources/k/pk/1.tar.gz", "sources/k/pk/2.tar.gz"}


def test_a_batch_reads_nothing_of_the_table(spark, tmp_path):
    """A base that cannot be read any more does not stop a stream that has its state."""
    feed = Feed(spark, str(tmp_path))
    feed.take([row(f"p{i}", "1", "a", i) for i in range(50)])
    sync.compact(spark, feed.index)
    base = sync.Store(spark, feed.index).base()[0]
    for f in (tmp_path / "index" / base).rglob("*.parquet"):
        f.write_bytes(b"no parquet")
    for f in (tmp_path / "index" / base).rglob("*.crc"):
        f.unlink()
    feed.take([row(f"p{i}", "1", "a" if i % 2 else "b", i) for i in range(50)])
    assert feed.changed() == [25]


def test_a_new_stream_starts_from_the_table(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    feed.take([row("p", "1", "a", 1), row("q", "1", "b", 2)])
    feed.take([row("p", "1", "a", 1), row("q", "1", "c", 1)], "two")
    assert feed.changed() == [2, 1] and feed.rows() == [("p", "1", "a"), ("q", "1", "c")]
    feed.take([row("q", "1", "b", 9)])  # the first stream knows nothing of the second's change: equal to what it last said
    assert feed.rows() == [("p", "1", "a"), ("q", "1", "c")]


def test_a_first_batch_that_runs_again_writes_the_same(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    feed.take([row("p", "1", "a", 1), row("q", "1", "b", 2)])
    for f in (tmp_path / "cp-one" / "commits").iterdir():
        f.unlink()  # as if the job had stopped between its write and its commit
    feed.take([row("r", "1", "c", 3)])
    assert feed.rows() == [("p", "1", "a"), ("q", "1", "b"), ("r", "1", "c")]


def test_compaction_rewrites_only_partitions_concerned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sync, "PART_ROWS", 20)
    feed = Feed(spark, str(tmp_path))
    feed.take([row(f"p{i}", "1", "a", i) for i in range(100)])
    sync.compact(spark, feed.index)
    store = sync.Store(spark, feed.index)
    assert store.base() == ("base-8", 8)
    files = lambda: {f: f.stat().st_mtime_ns for f in (tmp_path / "index" / "base-8").rglob("*.parquet")}
    before = files()
    feed.take([row("p7", "1", "z", 200), row("p7", "2", "z", 201)])
    sync.compact(spark, feed.index)
    after = files()
    mine = f"part={sync.read_index(spark, feed.index).where('provider_id = \'p7\'').select(sync.part(8)).first()[0]}"
    assert {f.parent.name for f in before if f not in after} == {f.parent.name for f in after if f not in before} == {mine}
    assert len(feed.rows()) == 101 and ("p7", "1", "z") in feed.rows()
    feed.take([row(f"n{i}", "1", "a", i) for i in range(100)])
    sync.compact(spark, feed.index)
    assert store.base() == ("base-16", 16) and len(feed.rows()) == 201 and [n for n in store.names() if n.startswith("base")] == ["base-16"]


def test_a_compaction_that_stops_anywhere_loses_nothing(spark, tmp_path, monkeypatch):
    feed = Feed(spark, str(tmp_path))
    feed.take([row(f"p{i}", "1", "a", i) for i in range(30)])
    sync.compact(spark, feed.index)
    feed.take([row(f"p{i}", "1", "b", i) for i in range(10)])
    want = sorted([(f"p{i}", "1", "b" if i < 10 else "a") for i in range(30)])
    store = sync.Store(spark, feed.index)
    real = sync._write

    def stop_within(rows, path, parts, **options):
        for n in store.names("base-1"):
            store.remove(f"base-1/{n}") if n.startswith("part=") else None  # old partitions gone, new ones not there
        raise RuntimeError("lost")

    monkeypatch.setattr(sync, "_write", stop_within)
    with pytest.raises(RuntimeError, match="lost"):
        sync.compact(spark, feed.index)
    assert feed.rows() == want and store.whole("staged-")
    monkeypatch.setattr(sync, "_write", real)
    sync.compact(spark, feed.index)
    assert feed.rows() == want and not store.whole("staged-") and feed.changed() == []


def test_waiting_changes_are_compacted_by_the_stream(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sync, "COMPACT_AFTER", 2)
    feed = Feed(spark, str(tmp_path))
    for n, digest in enumerate("abc"):
        feed.take([row("p", "1", digest, n)])
    assert len(feed.changed()) == 1 and feed.rows() == [("p", "1", "c")]
