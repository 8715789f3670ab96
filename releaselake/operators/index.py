"""The release index: what is kept, what is new, what is carried over."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.items import library_name, sparse_path

RELEASE = ["provider_id", "kind", "id"]
META = ["yanked", "cksum", "rust_version", "created_at", "feature_names", "deps"]
ARTIFACT = ["blob", "sha256", "format"]


def registry_meta(rows: DataFrame, api: DataFrame) -> DataFrame:
    """Registry rows (package, vers, cksum, yanked, features, deps) with the API's rust_version and created_at as release meta.

    A missing flag is false, a missing ``default_features`` true, a missing dependency kind normal; empty strings of the API are null."""
    dep = lambda d: F.struct(
        d["name"].alias("name"), d["req"].alias("req"), F.coalesce(d["optional"], F.lit(False)).alias("optional"),
        F.coalesce(d["default_features"], F.lit(True)).alias("default_features"), F.coalesce(d["kind"], F.lit("normal")).alias("kind"),
    )
    names = F.coalesce(F.array_sort(F.map_keys("features")), F.array().cast("array<string>"))
    deps = F.coalesce(F.transform("deps", dep), F.array().cast("array<struct<name:string,req:string,optional:boolean,default_features:boolean,kind:string>>"))
    known = api.select("package", F.col("num").alias("vers"), F.nullif("rust_version", F.lit("")).alias("rust_version"), F.nullif("created_at", F.lit("")).alias("created_at"))
    out = rows.join(known, ["package", "vers"], "left")
    return out.select("package", "vers", F.coalesce("yanked", F.lit(False)).alias("yanked"), "cksum", "rust_version", "created_at", names.alias("feature_names"), deps.alias("deps"))


def drop_excluded(releases: DataFrame, excluded: DataFrame) -> DataFrame:
    """Without the versions that a provider excludes: ``excluded(provider_id, vers)``."""
    return releases.join(excluded, ["provider_id", "vers"], "left_anti")


def forced_releases(specs: DataFrame) -> DataFrame:
    """``PKG@VERS`` specs as package, vers; the first @ divides."""
    parts = F.split("spec", "@", 2)
    return specs.select(F.get(parts, 0).alias("package"), F.get(parts, 1).alias("vers")).where("vers is not null").distinct()


def classify(releases: DataFrame, prior: DataFrame, forced: DataFrame | None = None, dry_run: bool = False) -> DataFrame:
    """Releases with ``status`` and ``blob``. A release is fresh if the prior index has it with an equal checksum (two nulls are equal) and a
    blob. Fresh ones are ``reused`` unless forced, all others ``new``; a dry run plans ``reuse`` or ``would fetch`` and forces nothing."""
    before = prior.select(*[F.col(c) for c in RELEASE], F.col("cksum").alias("_cksum"), F.col("blob").alias("_blob"), F.lit(True).alias("_known"))
    out = releases.join(before, RELEASE, "left")
    fresh = F.coalesce(F.col("_known"), F.lit(False)) & F.col("_cksum").eqNullSafe(F.col("cksum")) & F.col("_blob").isNotNull()
    if dry_run:
        status = F.when(fresh, "reuse").otherwise("would fetch")
        keep = fresh
    else:
        must = F.lit(False)
        if forced is not None:
            out = out.join(forced.select("package", F.col("vers").alias("id"), F.lit(True).alias("_forced")), ["package", "id"], "left")
            must = F.coalesce(F.col("_forced"), F.lit(False))
        keep = fresh & ~must
        status = F.when(keep, "reused").otherwise("new")
    return out.withColumn("status", status).withColumn("blob", F.when(keep, F.col("_blob"))).drop("_cksum", "_blob", "_known", "_forced")


def sync_counts(classified: DataFrame) -> DataFrame:
    """Releases, new and reused for each provider, and in all (provider_id null)."""
    return classified.rollup("provider_id").agg(F.count("*").alias("releases"), F.count_if(F.col("status") == "new").alias("new"), F.count_if(F.col("status") == "reused").alias("reused"))


def blob_path(kind: str, package: str, vers: str) -> F.Column:
    return F.concat_ws("/", F.lit("sources"), F.col(kind), F.col(package), F.concat(F.col(vers), F.lit(".tar.gz")))


def provider_record(config: DataFrame, api: DataFrame) -> DataFrame:
    """Providers as the index lists them. ``api(package, ord, repository, description)``: the last non-empty value counts, before the config's; roles default to fork."""
    last = lambda c: F.max_by(F.nullif(F.col(c), F.lit("")), F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), F.col("ord")))
    found = api.groupBy("package").agg(last("repository").alias("_repository"), last("description").alias("description"))
    out = config.join(found, "package", "left")
    return out.select(
        "ord", "id", "package", library_name(F.col("lib_name"), F.col("package")).alias("lib_name"), F.coalesce("role", F.lit("fork")).alias("role"), "served_id",
        F.coalesce("_repository", F.nullif("repository", F.lit(""))).alias("repository"), "description", "note", sparse_path(F.col("package")).alias("index_path"),
    )


def unknown_providers(selected: DataFrame, config: DataFrame) -> DataFrame:
    """Selected ids that the config does not have; a run with any is an error."""
    return selected.select("id").join(config.select("id"), "id", "left_anti").distinct()


def carry_forward(config: DataFrame, prior: DataFrame, selected: DataFrame) -> DataFrame:
    """Unselected providers that the prior index has: its repository (else the config's) and description, all other fields from the config; their releases stay as they are."""
    before = prior.select("id", F.nullif("repository", F.lit("")).alias("_repository"), F.col("description").alias("_description"))
    kept = config.join(selected.select("id"), "id", "left_anti").join(before, "id")
    return kept.select(
        "ord", "id", "package", library_name(F.col("lib_name"), F.col("package")).alias("lib_name"), F.coalesce("role", F.lit("fork")).alias("role"), "served_id",
        F.coalesce("_repository", F.nullif("repository", F.lit(""))).alias("repository"), F.col("_description").alias("description"), "note",
    )


def merged_index(synced: DataFrame, carried: DataFrame) -> DataFrame:
    """Synced and carried providers in config order (``ord``)."""
    return synced.unionByName(carried, allowMissingColumns=True).orderBy("ord")


def nested(releases: DataFrame) -> DataFrame:
    """One row for each provider, its sources and their releases in order; ``releases(provider_id, kind, ord, id)`` with any of META and of ARTIFACT.

    The artifact of a release without a blob is null."""
    meta, artifact = ([c for c in names if c in releases.columns] for names in (META, ARTIFACT))
    held = F.when(F.col("blob").isNotNull(), F.struct(*artifact))
    release = F.struct("ord", "id", F.struct(*meta).alias("meta"), held.alias("artifact"))
    sources = releases.groupBy("provider_id", "kind").agg(F.array_sort(F.collect_list(release)).alias("releases"))
    plain = F.transform("releases", lambda r: F.struct(r["artifact"].alias("artifact"), r["id"].alias("id"), r["meta"].alias("meta")))
    return sources.groupBy("provider_id").agg(F.array_sort(F.collect_list(F.struct("kind", plain.alias("releases")))).alias("sources"))
