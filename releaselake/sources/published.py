"""An export that is published by differences: a hash tree over its documents, stored beside them, names those that moved, and only these are written.

A document's leaf holds the digest of its canonical line. Leaves fall into buckets by the first hex digits of their id's hash; a bucket's digest is over its
leaves', that of a shorter prefix over its sixteen children's, up to the root. Two trees are compared from the root down, and only nodes below ones that differ are looked
at. Each publication is a version: its lines, then its tree, whose leaves tell in which version a document's line lies. A version
counts once its tree is written, so that one that stops half way changes nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import finished, folder_names

DEPTH = 3  # hex digits that name a bucket
LEAF = "id string, bucket string, digest string, version int"
NODE = "level int, node string, digest string"


def leaves(lines: DataFrame) -> DataFrame:
    """id, bucket, digest of documents ``lines(id, json)``; ids are unique."""
    return lines.select("id", F.substring(F.sha2("id", 256), 1, DEPTH).alias("bucket"), F.sha2("json", 256).alias("digest"))


def nodes(leaf: DataFrame) -> DataFrame:
    """level, node, digest of the inner nodes: buckets at level ``DEPTH``, the root at level 0. A bucket gathers some 4096th of the leaves' digests, the others sixteen each."""
    joined = lambda by: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(by, "digest"))), lambda x: F.concat(x[by], F.lit(":"), x["digest"])), ","), 256).alias("digest")
    level = leaf.groupBy(F.col("bucket").alias("node")).agg(joined("id"))
    out = level.select(F.lit(DEPTH).alias("level"), "node", "digest")
    for depth in range(DEPTH - 1, -1, -1):
        level = level.groupBy(F.substring("node", 1, depth).alias("up")).agg(joined("node")).withColumnRenamed("up", "node")
        out = out.unionByName(level.select(F.lit(depth).alias("level"), "node", "digest"))
    return out


def differing(old: DataFrame, new: DataFrame) -> list[str]:
    """The buckets whose leaves differ between two trees' nodes, found from the root down; at most 16 ** ``DEPTH``."""
    found = [""]
    for level in range(DEPTH + 1):
        below = lambda t: t.where((F.col("level") == level) & F.substring("node", 1, max(0, level - 1)).isin(found))  # noqa: B023, E731
        a, b = below(old).select("node", F.col("digest").alias("was")), below(new).select("node", F.col("digest").alias("now"))
        found = [r.node for r in a.join(b, "node", "full").where(~F.col("was").eqNullSafe(F.col("now"))).select("node").collect()]
        if not found:
            return []
    return found


def moved(old: DataFrame, new: DataFrame, buckets: list[str]) -> DataFrame:
    """id, change (changed, new or vanished) of leaves in given buckets."""
    a, b = (t.where(F.col("bucket").isin(buckets)).select("id", F.col("digest").alias(c)) for t, c in ((old, "was"), (new, "now")))
    change = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "vanished").otherwise("changed")
    return a.join(b, "id", "full").where(~F.col("was").eqNullSafe(F.col("now"))).select("id", change.alias("change"))


def version(spark: SparkSession, path: str) -> int:
    """The last whole version, 0 if there is none."""
    return max((int(n) for n in folder_names(spark, f"{path}/leaves") if finished(spark, f"{path}/leaves/{n}")), default=0)


def tree(spark: SparkSession, path: str, at: int) -> tuple[DataFrame, DataFrame]:
    """Leaves and nodes of a version; those of version 0 are none."""
    if not at:
        return spark.createDataFrame([], LEAF), spark.createDataFrame([], NODE)
    return spark.read.schema(LEAF).parquet(f"{path}/leaves/{at}"), spark.read.schema(NODE).parquet(f"{path}/nodes/{at}")


def publish(lines: DataFrame, path: str) -> DataFrame:
    """Write the documents ``lines(id, json)`` that moved since the last version, and the new tree; returns id and change of those, none if nothing moved.

    ``lines`` should be cheap to read several times."""
    spark, path = lines.sparkSession, path.rstrip("/")
    before = version(spark, path)
    old, old_nodes = tree(spark, path, before)
    at = before + 1
    new = leaves(lines)
    nodes(new).write.mode("overwrite").parquet(f"{path}/nodes/{at}")
    buckets = differing(old_nodes, spark.read.schema(NODE).parquet(f"{path}/nodes/{at}"))
    if before and not buckets:
        return spark.createDataFrame([], "id string, change string")
    moved(old, new, buckets).write.mode("overwrite").parquet(f"{path}/moved/{at}")
    change = spark.read.schema("id string, change string").parquet(f"{path}/moved/{at}")
    lines.join(change.where("change <> 'vanished'"), "id", "left_semi").select("id", "json").write.mode("overwrite").parquet(f"{path}/lines/{at}")
    placed = new.join(change, "id", "left").join(old.select("id", F.col("version").alias("was_in")), "id", "left")
    held = placed.select("id", "bucket", "digest", F.when(F.col("change").isNotNull(), at).otherwise(F.col("was_in")).alias("version"))
    held.repartitionByRange("bucket").sortWithinPartitions("bucket", "id").write.mode("overwrite").parquet(f"{path}/leaves/{at}")
    return change


def published(spark: SparkSession, path: str, at: int | None = None) -> DataFrame:
    """id, json, version of the documents of a version, the last one unless given: each line as the version that wrote it last has it."""
    path = path.rstrip("/")
    at = at or version(spark, path)
    if not at:
        return spark.createDataFrame([], "id string, json string, version int")
    leaf = tree(spark, path, at)[0].select("id", "version")
    every = [spark.read.schema("id string, json string").parquet(f"{path}/lines/{n}").withColumn("version", F.lit(n)) for n in range(1, at + 1) if finished(spark, f"{path}/lines/{n}")]
    lines = every[0]
    for more in every[1:]:
        lines = lines.unionByName(more)
    return lines.join(leaf, ["id", "version"]).select("id", "json", "version")
