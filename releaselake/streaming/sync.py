"""Incremental sync as a micro-batch job: files of registry rows arrive, and the index table keeps one current row for each release.

What each release's digest is now is state of the stream, keyed by slots of releases, so that a batch is classified without reading the table: within a batch the last
row of a release counts, and it is a change if its digest is another than the one before. A batch's changes are appended under its number. A batch that
runs again gets the same state and writes the same number again, so that nothing is lost or counted twice. A stream with a new checkpoint starts from the table's digests.

``compact`` folds changes into the base: merged rows of the partitions concerned are staged, then replace just those partitions (copy on write, dynamic partition
overwrite), then the changes go. Whenever that stops, base, staged rows and changes together still hold every release, and the row of the highest number is current. The
base has a power of two of partitions by hash of the provider, which doubles as the table grows.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.index import RELEASE, blob_path

CHANGE = "provider_id string, kind string, id string, package string, cksum string"
INDEX = f"{CHANGE}, blob string, batch long"
PART_ROWS = 1_000_000  # rows for a partition of the base from which their number doubles
SPREAD = 8  # tasks that write one partition, so that a provider with many releases is none's alone
SLOTS = 1 << 14  # groups of the state, each with its share of all releases; a checkpoint is bound to their number
COMPACT_AFTER = 16  # batches that wait as changes
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class LastDigests(StatefulProcessor):
    """Passes on the last row of a batch of each release whose digest is not the one that the release has by now. A group is a slot of releases, whose digests are read and written at once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "held string")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timers: object) -> Iterator[Row]:
        last: dict[tuple, Row] = {}
        for r in rows:
            release = (r.provider_id, r.kind, r.id)
            seen = last.get(release)
            if seen is None or (r.seq, r.cksum or "") > (seen.seq, seen.cksum or ""):
                last[release] = r
        was = self.held.get()
        held = {tuple(release): digest for *release, digest in json.loads(was[0])} if was else {}
        changed = [r for release, r in last.items() if release not in held or held[release] != r.cksum]
        if changed:
            held.update(((r.provider_id, r.kind, r.id), r.cksum) for r in changed)
            self.held.update((json.dumps([[*release, digest] for release, digest in held.items()]),))
        for r in changed:
            yield Row(provider_id=r.provider_id, kind=r.kind, id=r.id, package=r.package, cksum=r.cksum)

    def handleInitialState(self, key: tuple, initial: Row, timers: object) -> None:
        self.held.update((initial.held,))

    def close(self) -> None:
        pass


def _slot() -> Column:
    return F.pmod(F.xxhash64(*RELEASE), F.lit(SLOTS)).alias("_slot")


def changes(arriving: DataFrame, index: DataFrame) -> DataFrame:
    """The stream of rows (provider_id, kind, id, package, cksum, seq) that change the index; ``index`` is what a stream without a past starts from."""
    initial = index.groupBy(_slot()).agg(F.to_json(F.collect_list(F.array(*RELEASE, "cksum"))).alias("held"))
    return arriving.withColumn("_slot", _slot()).groupBy("_slot").transformWithState(LastDigests(), CHANGE, "append", "none", initialState=initial.groupBy("_slot"))


class Store:
    """The folders of an index table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str = "") -> list[str]:
        at = self.hadoop(f"{self.path}/{folder}")
        return sorted(s.getPath().getName() for s in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def remove(self, name: str) -> None:
        self.fs.delete(self.hadoop(f"{self.path}/{name}"), True)

    def whole(self, start: str) -> list[str]:
        """Folders of that name whose writing ended."""
        return [n for n in self.names() if n.startswith(start) and self.fs.exists(self.hadoop(f"{self.path}/{n}/_SUCCESS"))]

    def base(self) -> tuple[str, int] | None:
        """The folder of the base and its number of partitions."""
        found = [(n, int(n.partition("-")[2])) for n in self.whole("base-")]
        return max(found, key=lambda b: b[1], default=None)

    def numbers(self) -> list[int]:
        return sorted(map(int, self.names("changes")))

    def read(self, *folders: str) -> DataFrame:
        plain = [f for f in folders if not f.startswith("base-")]
        tables = [self.spark.read.schema(INDEX).parquet(*(f"{self.path}/{f}" for f in group)) for group in (plain, *([f] for f in folders if f not in plain)) if group]
        return reduce(DataFrame.union, (t.select(*_names(INDEX)) for t in tables))

    def epoch(self, checkpoint: str) -> int:
        """The place of a stream among those that write the table; a new one comes last."""
        name = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
        known = {n.partition("-")[2]: int(n.partition("-")[0]) for n in self.names("streams")}
        if name not in known:
            known[name] = max(known.values(), default=0) + 1
            self.fs.mkdirs(self.hadoop(f"{self.path}/streams/{known[name]:08d}-{name}"))
        return known[name]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def part(parts: int) -> Column:
    return F.pmod(F.xxhash64("provider_id"), F.lit(parts)).cast("int")


def current(rows: DataFrame) -> DataFrame:
    """The row of the highest batch number of each release."""
    rest = [c for c in _names(INDEX) if c not in RELEASE]
    best = rows.groupBy(*RELEASE).agg(F.max(F.struct("batch", *(c for c in rest if c != "batch"))).alias("r"))
    return best.select(*RELEASE, *(F.col(f"r.{c}").alias(c) for c in rest)).select(*_names(INDEX))


def read_index(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The current row of each release, of batches with a number below ``before`` if given; a table that does not exist yet is empty."""
    store = Store(spark, path)
    base = store.base()
    folders = [*([base[0]] if base else []), *store.whole("staged-"), *(f"changes/{n}" for n in store.numbers() if before is None or n < before)]
    if not folders:
        return spark.createDataFrame([], INDEX)
    rows = store.read(*folders)
    return current(rows if before is None else rows.where(F.col("batch") < before))


def _write(rows: DataFrame, path: str, parts: int, **options: str) -> None:
    rows = rows.withColumn("part", part(parts)).repartition("part", F.pmod(F.xxhash64("id"), F.lit(SPREAD)))
    rows.write.mode("overwrite").options(**options).partitionBy("part").parquet(path)


def compact(spark: SparkSession, path: str, before: int | None = None) -> int:
    """Fold the changes of batches with a number below ``before`` (all, if none is given) into the base; returns how many batches that were."""
    store = Store(spark, path)
    base = store.base()
    for name in store.names():  # what an earlier run left
        if name.startswith("staged-"):
            if base and name in store.whole("staged-"):
                _write(store.read(name), f"{store.path}/{base[0]}", base[1], partitionOverwriteMode="dynamic")
            store.remove(name)
        elif name.startswith("base-") and (base is None or name != base[0]):
            store.remove(name)
    folded = [n for n in store.numbers() if before is None or n < before]
    if not folded:
        return 0
    new = current(store.read(*(f"changes/{n}" for n in folded)))
    held = store.read(base[0]).count() if base else 0
    rows = held + new.count()
    parts = base[1] if base else 1
    grown = parts
    while rows > grown * PART_ROWS:
        grown *= 2
    if base is None or grown > parts:
        every = new.unionByName(store.read(base[0])) if base else new
        _write(current(every), f"{store.path}/base-{grown}", grown)
        if base:
            store.remove(base[0])
    else:
        touched = [r.part for r in new.select(part(parts).alias("part")).distinct().collect()]  # at most ``parts``
        there = [f"{base[0]}/{name}" for name in store.names(base[0]) if name in {f"part={p}" for p in touched}]
        old = store.read(*there) if there else spark.createDataFrame([], INDEX)
        staged = f"staged-{folded[-1]}"
        current(new.unionByName(old)).write.mode("overwrite").parquet(f"{store.path}/{staged}")
        _write(store.read(staged), f"{store.path}/{base[0]}", parts, partitionOverwriteMode="dynamic")
        for n in folded:  # before the staged rows, which stand for them if this stops
            store.remove(f"changes/{n}")
        store.remove(staged)
    for n in folded:
        store.remove(f"changes/{n}")
    return len(folded)


@contextmanager
def _state_in_rocksdb(spark: SparkSession) -> Iterator[None]:
    """State of the kind that keyed operators need, for streams that start here."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def run_available(arriving: DataFrame, index_path: str, checkpoint: str) -> StreamingQuery:
    """Take in what has arrived by now and stop; the checkpoint remembers it, and the digests that releases have."""
    spark = arriving.sparkSession
    store = Store(spark, index_path)
    first = store.epoch(checkpoint) << 32

    def step(batch: DataFrame, batch_id: int) -> None:
        here = first + batch_id
        if len(store.numbers()) >= COMPACT_AFTER:
            compact(batch.sparkSession, index_path, here)
        rows = batch.withColumn("blob", blob_path("kind", "package", "id")).withColumn("batch", F.lit(here))
        rows.select(*_names(INDEX)).write.mode("overwrite").parquet(f"{store.path}/changes/{here}")

    with _state_in_rocksdb(spark):
        out = changes(arriving, read_index(spark, index_path, first))
        return out.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
