"""Release blobs: their members, digests and checks."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

KEPT = r"^(Cargo\.toml|build\.rs|src/.+)$"
MANIFEST = "Cargo.toml"


def unpacked(blobs: DataFrame) -> DataFrame:
    """package, vers, path, mode, content, head, manifest: regular members of gzipped tar blobs ``(package, vers, content)``, as named in the archive; head marks
    the first of each blob, manifest tells whether the blob has one below its top folder. A blob without members is one row without a path. One blob is held at a time."""
    names = ["package", "vers", "path", "mode", "content", "head", "manifest"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for b in batch.itertuples(index=False):
                with tarfile.open(fileobj=io.BytesIO(gzip.decompress(b.content))) as tar:
                    found = [(m.name, m.mode, tar.extractfile(m).read()) for m in tar if m.isfile()]
                whole = any(name.partition("/")[2] == MANIFEST for name, _, _ in found)
                rows = [(b.package, b.vers, *m, i == 0, whole) for i, m in enumerate(found or [(None, None, None)])]
                yield pd.DataFrame(rows, columns=names).astype({"mode": "Int32"})

    return blobs.select("package", "vers", "content").mapInPandas(run, "package string, vers string, path string, mode int, content binary, head boolean, manifest boolean")


def packed(members: DataFrame) -> DataFrame:
    """package, vers, content: each release's members ``(package, vers, path, mode, content)`` as a gzipped tar blob, the same bytes for the same members: by path, without times or owners."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with tarfile.open(fileobj=buffer, mode="w", format=tarfile.PAX_FORMAT) as tar:
            for m in rows.sort_values("path").itertuples(index=False):
                info = tarfile.TarInfo(m.path)
                info.size, info.mode = len(m.content), int(m.mode)
                tar.addfile(info, io.BytesIO(m.content))
        return pd.DataFrame({"package": rows["package"].iloc[:1], "vers": rows["vers"].iloc[:1], "content": [gzip.compress(buffer.getvalue(), 9, mtime=0)]})

    return members.groupBy("package", "vers").applyInPandas(run, "package string, vers string, content binary")


def wanted_blobs(measured: DataFrame, releases: DataFrame, blobs: DataFrame) -> DataFrame:
    """The blobs of measured entities: ``measured(id)``, ``releases(provider_id, package, vers, blob)``, ``blobs(package, vers, content)``. Releases without a blob have none."""
    wanted = releases.where("blob is not null").join(measured.select(F.col("id").alias("provider_id")), "provider_id", "left_semi").select("package", "vers").distinct()
    return blobs.join(wanted, ["package", "vers"], "left_semi")


def is_unsafe(path: Column) -> Column:
    """Absolute, or leading out of the root at some point. Depth after each part, by a running sum."""
    step = lambda p: F.when(p == "..", -1).when((p == "") | (p == "."), 0).otherwise(1)
    walked = F.aggregate(F.split(path, "/"), F.struct(F.lit(0).alias("at"), F.lit(0).alias("low")), lambda a, p: F.struct((a["at"] + step(p)).alias("at"), F.least(a["low"], a["at"] + step(p)).alias("low")))
    return path.startswith("/") | (walked["low"] < 0)


def below_top(path: Column) -> Column:
    """The path within the archive's top folder; empty for what does not lie in it."""
    return F.regexp_extract(path, r"^[^/]+/(.+)$", 1)


def refusal(path: Column, manifest: Column) -> Column:
    """Why a member's blob is refused: the member leads out of the archive or of its top folder, or the blob has no manifest; else null."""
    return F.when(~manifest, F.lit("no manifest")).when(is_unsafe(path) | is_unsafe(below_top(path)), F.concat(F.lit("unsafe path "), path))


def refused(blobs: DataFrame) -> DataFrame:
    """package, vers, reason of the blobs that an extraction refuses, each with the least of its reasons."""
    return unpacked(blobs).withColumn("reason", refusal(F.col("path"), F.col("manifest"))).where("reason is not null").groupBy("package", "vers").agg(F.min("reason").alias("reason"))


def extracted(measured: DataFrame, releases: DataFrame, blobs: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Members of the blobs of measured entities. A blob that is ``refused`` fails the job, in the task that opens it.

    ``counts`` observes how many blobs and members the extraction has, in the same pass."""
    members = unpacked(wanted_blobs(measured, releases, blobs))
    reason = refusal(F.col("path"), F.col("manifest"))
    stop = F.raise_error(F.concat(reason, F.lit(" in the blob of "), F.col("package"), F.lit("@"), F.col("vers"))).cast("boolean")
    fine = members.where(F.when(reason.isNotNull(), stop).otherwise(True))
    fine = fine if counts is None else fine.observe(counts, F.count_if("head").alias("blobs"), F.count("path").alias("members"))
    return fine.select("package", "vers", "path", "mode", "content")


def source_members(members: DataFrame) -> DataFrame:
    """Members below the archive's top folder, without it: the manifest, the build script and sources; modes are 755 or 644. One that leads out of the folder fails the job."""
    kept = members.withColumn("path", below_top(F.col("path"))).where(F.col("path").rlike(KEPT))
    stop = F.raise_error(F.concat(F.lit("unsafe path "), F.col("path"))).cast("boolean")
    kept = kept.where(F.when(is_unsafe(F.col("path")), stop).otherwise(True))
    return kept.withColumn("mode", F.when(F.col("mode").bitwiseAND(0o111) != 0, F.lit(0o755)).otherwise(F.lit(0o644)))


def without_manifest(members: DataFrame) -> DataFrame:
    """package, vers of blobs whose kept members have no manifest; these are errors."""
    return members.groupBy("package", "vers").agg(F.bool_or(F.col("path") == MANIFEST).alias("_has")).where("not _has").select("package", "vers")


def described(blobs: DataFrame, kind: str) -> DataFrame:
    """blob path, sha256 and format of each (package, vers, content)."""
    path = F.concat_ws("/", F.lit("sources"), F.lit(kind), F.col("package"), F.concat(F.col("vers"), F.lit(".tar.gz")))
    return blobs.select("package", "vers", path.alias("blob"), F.sha2("content", 256).alias("sha256"), F.lit("tar.gz").alias("format"))


def verified(releases: DataFrame, files: DataFrame) -> DataFrame:
    """Releases with ``state`` built or failed and the reason: content must be there and, where a checksum is given, match it. ``files(package, vers, content)``."""
    digests = files.select("package", "vers", F.sha2(F.col("content").cast("binary"), 256).alias("_sha"))
    out = releases.join(digests, ["package", "vers"], "left")
    reason = F.when(F.col("_sha").isNull(), "missing").when((F.coalesce("cksum", F.lit("")) != "") & (F.col("cksum") != F.col("_sha")), "mismatch")
    return out.withColumn("reason", reason).withColumn("state", F.when(reason.isNull(), "built").otherwise("failed")).drop("_sha")
