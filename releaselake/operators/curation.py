"""Human-edited layers over the dataset. Curated tables are small; Spark broadcasts them by their size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.versions import is_prerelease, semver_key
from .keep import keep_first


def latest_stable(releases: DataFrame, with_yanked: bool = False) -> DataFrame:
    """provider_id, vers: the highest release of each provider that is no pre-release and, unless asked for, not yanked."""
    fine = releases.where(~is_prerelease(F.col("vers")))
    fine = fine if with_yanked else fine.where(~F.coalesce("yanked", F.lit(False)))
    return fine.groupBy("provider_id").agg(F.max_by("vers", semver_key(F.col("vers"))).alias("vers"))


def companion_versions(releases: DataFrame, companions: DataFrame) -> DataFrame:
    """Every release with its provider's companion package and version: the release's own if the pin mirrors it, else the fixed one."""
    c = companions.select("provider_id", F.col("package").alias("companion"), "pin_kind", "pin_fixed")
    out = releases.join(c, "provider_id", "left")
    return out.withColumn("companion_vers", F.when(F.col("pin_kind") == "mirror", F.col("vers")).otherwise(F.col("pin_fixed"))).drop("pin_kind", "pin_fixed")


def compile_badges(releases: DataFrame, markers: DataFrame) -> DataFrame:
    """Releases with the toolchain that a marker says compiled them; null without one."""
    return releases.join(markers.select("provider_id", "vers", "toolchain"), ["provider_id", "vers"], "left")


def stale_markers(markers: DataFrame, latest: DataFrame) -> DataFrame:
    """Markers that no longer name their provider's latest stable release, with that release."""
    out = markers.join(latest.select("provider_id", F.col("vers").alias("latest")), "provider_id", "left")
    return out.where(~F.col("vers").eqNullSafe(F.col("latest"))).select("provider_id", "vers", "latest")


def binding_notes(releases: DataFrame, notes: DataFrame) -> DataFrame:
    """The first note in order whose provider is the release's and that lists its version or bounds it from above. ``notes(ord, provider_id, versions, below, note)``."""
    n = notes.select(F.col("provider_id").alias("_for"), "ord", "versions", "below", "note")
    listed = F.coalesce(F.array_contains("versions", F.col("vers")), F.lit(False))
    below = F.coalesce(semver_key(F.col("vers")) < semver_key(F.col("below")), F.lit(False))
    met = releases.join(n, (F.col("provider_id") == F.col("_for")) & (listed | below))
    return keep_first(met, ["provider_id", "vers"], [F.col("ord")]).select("provider_id", "vers", "note")


def source_links(items: DataFrame, upstream: DataFrame) -> DataFrame:
    """Items (provider_id, vers, key, file, start, end) with the parts of a permalink and its address; null without a source map or a place."""
    u = upstream.select("provider_id", "repo", "tree", F.col("tag").alias("_tag"))
    out = items.join(u, "provider_id", "left")
    tag = F.concat(F.coalesce("_tag", F.lit("")), F.col("vers"))
    place = F.col("repo").isNotNull() & F.col("file").isNotNull()
    link = F.concat(F.lit("https://github.com/"), F.col("repo"), F.lit("/blob/"), tag, F.lit("/"), F.col("tree"), F.lit("/"), F.col("file"), F.lit("#L"), F.col("start"), F.lit("-L"), F.col("end"))
    return out.withColumn("ref", F.when(place, tag)).withColumn("link", F.when(place, link)).drop("_tag")


def rule_check(rules: DataFrame, versions: DataFrame, items: DataFrame, gates_on: DataFrame | None = None) -> DataFrame:
    """id and status of each rule: whether both ends exist with the recorded hash, and its keys fit their surfaces.

    ``rules(id, from_key, to_key, from_provider, from_version, from_hash, to_provider, to_version, to_hash, human_confirmed)``, ``versions(provider_id, vers, api_hash)``,
    ``items(provider_id, vers, key, cfg)``, ``gates_on(gate)``: the gates that the target build enables."""
    out = rules
    for end in ("from", "to"):
        v = versions.select(F.col("provider_id").alias(f"{end}_provider"), F.col("vers").alias(f"{end}_version"), F.col("api_hash").alias(f"_{end}_hash"))
        out = out.join(v, [f"{end}_provider", f"{end}_version"], "left")
    for what, end, key in (("old", "from", "from_key"), ("still", "to", "from_key"), ("new", "to", "to_key")):
        wanted = rules.select(F.col(f"{end}_provider").alias("provider_id"), F.col(f"{end}_version").alias("vers"), F.col(key).alias("key")).distinct()
        hit = items.join(wanted, ["provider_id", "vers", "key"], "left_semi").groupBy("provider_id", "vers", "key").agg(F.min_by("cfg", F.struct(F.size("cfg"), F.col("cfg"))).alias(f"_{what}"))
        hit = hit.select(F.col("provider_id").alias(f"{end}_provider"), F.col("vers").alias(f"{end}_version"), F.col("key").alias(key), f"_{what}")
        out = out.join(hit, [f"{end}_provider", f"{end}_version", key], "left")
    if gates_on is not None:
        on = gates_on.agg(F.collect_set("gate").alias("_on"))
        out = out.crossJoin(F.broadcast(on))
    else:
        out = out.withColumn("_on", F.array().cast("array<string>"))
    status = (
        F.when(~F.coalesce("human_confirmed", F.lit(False)), "unconfirmed")
        .when(F.col("_from_hash").isNull() | F.col("_to_hash").isNull(), "release missing")
        .when((F.col("_from_hash") != F.col("from_hash")) | (F.col("_to_hash") != F.col("to_hash")), "hash moved")
        .when(F.col("_old").isNull(), "old key absent")
        .when(F.col("_still").isNotNull(), "old key still there")
        .when(F.col("_new").isNull(), "new key absent")
        .when(F.size(F.array_except("_new", "_on")) > 0, "gated")
        .otherwise("applies")
    )
    return out.select("id", status.alias("status"))


def kit_offers(wanted: DataFrame, probes: DataFrame) -> DataFrame:
    """Pairs (kit, target) that may be offered: those that a probe covers."""
    return wanted.join(probes.select("kit", "target").distinct(), ["kit", "target"], "left_semi")


