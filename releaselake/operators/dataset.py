"""The contract dataset: which releases are measured and what is known before measuring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.items import library_name
from ..functions.versions import padded

KIND = "registry"
#: Fields that only a measurement fills; null means unmeasured and is never replaced by a default.
MEASURED = ("toolchain_floor", "versem", "api_hash", "tvm", "eac")


def role(entities: DataFrame) -> Column:
    return F.coalesce(entities["role"], F.lit("fork"))


def forks(entities: DataFrame) -> DataFrame:
    return entities.where(role(entities) == "fork")


def skipped(entities: DataFrame) -> DataFrame:
    """Entities that stay out of the dataset, with a label that says why."""
    r = role(entities)
    return entities.where(r != "fork").select("id", r.alias("role"), F.concat(F.col("id"), F.lit(" ("), r, F.lit(")")).alias("label"))


def contract_versions(entities: DataFrame, releases: DataFrame, source_kind: str = "registry-index") -> DataFrame:
    """One row for each release of a fork from the given kind of source, unmeasured."""
    mine = forks(entities).select(F.col("id").alias("provider_id"), library_name(F.col("lib_name"), F.col("package")).alias("lib_name"))
    rows = releases.where(F.col("kind") == source_kind).drop("kind").join(mine, "provider_id")
    return rows.withColumn("kind", F.lit(KIND)).withColumns({c: F.lit(None).cast("string") for c in MEASURED})


def coverage_stamp(releases: DataFrame) -> DataFrame:
    """synced_at: the newest readable created_at of all releases, with its own offset, without fractions; null if there is none.

    It is written in full: ``T`` before the time, seconds, ``Z`` as ``+00:00``. A stamp without offset is read as UTC and gets none; of equal times the greatest text counts."""
    at = F.try_to_timestamp(F.col("created_at"))
    best = F.max_by("created_at", F.struct(at, F.col("created_at")))
    newest = releases.where(at.isNotNull()).agg(best.alias("raw"))
    out = F.col("raw")
    for pattern, full in ((r"[.,][0-9]+", ""), (r"[zZ]$", "+00:00"), (r"^(\S{10})[ t]", "$1T"), (r"([+-]\d\d)(\d\d)$", "$1:$2"), (r"^(\d{4}-\d\d-\d\d)$", "$1T00:00:00"), (r"T(\d\d:\d\d)([+-].*)?$", "T$1:00$2")):
        out = F.regexp_replace(out, pattern, full)
    return newest.select(out.alias("synced_at"))


def measured_entities(entities: DataFrame) -> DataFrame:
    """Forks, and dependencies that serve a facade."""
    facades = entities.where("is_facade").select(F.col("id").alias("served_id"))
    serving = entities.where(role(entities) == "dependency").join(facades, "served_id", "left_semi").select(entities.columns)
    return forks(entities).unionByName(serving)


def facade_graph(entities: DataFrame) -> DataFrame:
    """facade_id, lib_name, package: which package a library name stands for in a facade; the last in config order wins."""
    facades = entities.where("is_facade").select(F.col("id").alias("facade_id"))
    serving = entities.where(role(entities) == "dependency").select(F.col("served_id").alias("facade_id"), library_name(F.col("lib_name"), F.col("package")).alias("lib_name"), "package", "ord")
    return serving.join(facades, "facade_id", "left_semi").groupBy("facade_id", "lib_name").agg(F.max_by("package", "ord").alias("package"))


def dependency_aliases(deps: DataFrame) -> DataFrame:
    """package, vers, name of normal dependencies, names as written; a null kind is normal."""
    return deps.where(F.coalesce("kind", F.lit("normal")) == "normal").select("package", "vers", "name").distinct()


def dataset_counts(versions: DataFrame) -> DataFrame:
    return versions.agg(F.count("*").alias("versions"), F.countDistinct("provider_id").alias("providers"))


def declared_floors(entities: DataFrame, releases: DataFrame) -> DataFrame:
    """Releases of forks that declare a compiler version."""
    mine = forks(entities).select(F.col("id").alias("provider_id"))
    return releases.where("rust_version <> ''").join(mine, "provider_id", "left_semi").withColumn("floor", padded(F.col("rust_version")))


def release_digests(entities: DataFrame, releases: DataFrame) -> DataFrame:
    mine = forks(entities).select(F.col("id").alias("provider_id"))
    return releases.join(mine, "provider_id", "left_semi").select("package", "vers", "cksum")
