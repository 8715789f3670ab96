"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_ROWS = 1_000
MOST_HOT = 65_536


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only in a local session that leaves that unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/releaselake/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def join_hot(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", counts: DataFrame | None = None) -> DataFrame:
    """A join on ``on`` in which a key of ``big`` may hold any share of its rows, while ``small`` has few rows for each key.

    Keys of over ``HOT_ROWS`` rows and over one row in ``MOST_HOT`` are hot, so that there are fewer than ``MOST_HOT`` of them whatever the input
    holds. A hot key's rows are salted into lots of about that many rows, and its rows of ``small`` are repeated for each lot. ``counts`` may give the
    rows of each key as ``on`` and ``n``; ``big`` should be cheap to read twice. Null keys never meet."""
    counts = big.groupBy(*on).agg(F.count("*").alias("n")) if counts is None else counts
    limit = max(HOT_ROWS, big.count() // MOST_HOT)
    hot = counts.where(F.col("n") > limit).select(*on, F.ceil(F.col("n") / F.lit(limit)).cast("int").alias("_lots")).dropna(subset=on)
    found = hot.collect()
    if not found:
        return big.join(small, on, how)
    hot = F.broadcast(big.sparkSession.createDataFrame(found, hot.schema))
    lots = F.coalesce("_lots", F.lit(1))
    dealt = big.join(hot, on, "left").withColumn("_lot", F.pmod(F.xxhash64(*(c for c in big.columns if c not in on)), lots).cast("int")).drop("_lots")
    spread = small.join(hot, on, "left").withColumn("_lot", F.explode(F.sequence(F.lit(0), lots - 1))).drop("_lots")
    return dealt.join(spread, [*on, "_lot"], how).drop("_lot")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, in whatever case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def doc_texts(docs: DataFrame) -> DataFrame:
    """doc_id and text alone, as a long and a never-null string."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def map_rows(df: DataFrame, schema: str, per_batch: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table]]) -> DataFrame:
    """mapInArrow with one ``per_batch()`` state (models, caches) for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = None
        for batch in batches:
            if batch.num_rows:
                step = step or per_batch()
                out = step(batch)
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def raw(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A string column as UTF-8 bytes, without decoding them."""
    return batch.column(name).cast(pa.binary()).to_pylist()


def hash_fraction(key: Column, salt: int) -> Column:
    """A reproducible number in [0, 1) from a key, for bounded samples that no order or layout changes."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(salt), key), 11)).cast("double") / F.lit(float(1 << 53))


class Offsets:
    """Byte offsets of a UTF-8 text as code point offsets; each is counted from the one asked for before."""

    def __init__(self, data: bytes):
        self.data, self.at, self.points, self.plain = data, 0, 0, data.isascii()

    def __call__(self, byte: int) -> int:
        if self.plain:
            return byte
        if byte < self.at:
            self.points -= len(self.data[byte : self.at].decode())
        else:
            self.points += len(self.data[self.at : byte].decode())
        self.at = byte
        return self.points
