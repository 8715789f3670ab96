"""The state of the sync stream: as many groups as there are slots, whatever the number of releases."""

from releaselake.streaming import sync

from .test_streams import ROWS, Feed, row


def test_state_does_not_have_a_group_for_each_release(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sync, "SLOTS", 4, raising=False)
    spark.createDataFrame([row(f"p{i % 7}", f"{i}", None if i == 5 else f"d{i % 3}", i) for i in range(200)], ROWS).write.parquet(f"{tmp_path}/in")
    run = sync.run_available(spark.readStream.schema(ROWS).parquet(f"{tmp_path}/in"), f"{tmp_path}/index", f"{tmp_path}/cp")
    run.awaitTermination()
    state = run.recentProgress[-1].stateOperators[0]
    assert 0 < state.numRowsTotal <= 4
    assert sync.read_index(spark, f"{tmp_path}/index").count() == 200


def test_releases_that_share_a_slot_keep_their_own_digests(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sync, "SLOTS", 1, raising=False)
    feed = Feed(spark, str(tmp_path))
    feed.take([row("p", "1", "a", 1), row("p", "2", None, 2), row('q"', "1", "ü", 3)])
    feed.take([row("p", "1", "b", 4), row("p", "1", "a", 5), row("p", "2", "c", 6), row('q"', "1", "ü", 7)])
    feed.take([row("p", "2", "c", 8), row('q"', "1", "x", 9), row("r", "1", None, 9)], "two")
    feed.take([row("p", "2", "c", 10), row("r", "1", None, 11)], "two")
    assert feed.changed() == [3, 1, 2] or feed.changed() == [3, 1, 2, 0]
    assert feed.rows() == [("p", "1", "a"), ("p", "2", "c"), ('q"', "1", "x"), ("r", "1", None)]
