"""Checks of a provider config, as rows (provider_id, check_no, message). Repeated ids are reported first, then provider by provider in config order the checks by number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROLES = ("fork", "dependency", "companion")
SOURCE_KINDS = ("registry-index",)
SURFACE_KIND = "reexports"


def violations(config: DataFrame) -> DataFrame:
    """``config(ord, id, package, role, served_id, sources array<struct<kind>>, exclude array<string>, surface_kind, surface_from array<string>)``.

    Column types already rule out malformed lists, so that an ``exclude`` or ``surface_from`` that could not be read shows as a null entry."""
    return _placed(config).select("provider_id", "check_no", "message")


def _placed(config: DataFrame) -> DataFrame:
    """The violations with ``pos``, the place of a surface source among its provider's; the three checks of one source come before the next one's."""
    role = F.coalesce("role", F.lit("fork"))

    def found(rows: DataFrame, no: int, message: Column) -> DataFrame:
        pos = F.col("pos") if 11 <= no <= 13 else F.lit(0)
        return rows.select(F.col("id").alias("provider_id"), F.lit(no).alias("check_no"), message.alias("message"), pos.alias("pos"))

    ids = config.select(F.col("id").alias("_known")).distinct()
    sourced = config.where("surface_kind is not null or surface_from is not null")
    named = sourced.select("id", F.posexplode("surface_from").alias("pos", "source"))
    sources = config.select(F.col("id").alias("source"), role.alias("source_role"), F.col("served_id").alias("source_for"), F.lit(True).alias("_there")).dropDuplicates(["source"])
    checked = named.join(sources, "source", "left")
    repeated = config.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    dangling = config.where("served_id is not null").join(ids, F.col("served_id") == F.col("_known"), "left_anti")
    kinds = config.select("id", F.explode("sources").alias("s")).select("id", F.col("s.kind").alias("kind"))
    say = F.concat
    out = [
        found(repeated, 1, F.lit("duplicate provider id")),
        found(config.where(~role.isin(*ROLES)), 2, say(F.lit("unknown role "), role)),
        found(dangling, 3, say(F.lit("serves unknown provider "), F.col("served_id"))),
        found(config.where(F.coalesce("package", F.lit("")) == ""), 4, F.lit("missing package")),
        found(config.where(F.coalesce(F.size("sources"), F.lit(0)) < 1), 5, F.lit("no sources declared")),
        found(config.where(F.exists("exclude", lambda v: v.isNull())), 6, F.lit("exclude must list version strings")),
        found(sourced.where(~F.col("surface_kind").eqNullSafe(F.lit(SURFACE_KIND))), 7, say(F.lit("unknown surface source kind "), F.coalesce("surface_kind", F.lit("none")))),
        found(sourced.where(F.coalesce(F.size("surface_from"), F.lit(0)) < 1), 8, F.lit("surface source lists no provider")),
        found(named.where("source is null"), 9, F.lit("surface source entries must be provider ids")),
        found(named.where("source is not null").groupBy("id", "source").agg(F.count("*").alias("n")).where("n > 1"), 10, say(F.lit("duplicate surface source "), F.col("source"))),
        found(checked.where("source is not null and _there is null"), 11, say(F.lit("surface source names unknown provider "), F.col("source"))),
        found(checked.where("_there and source_role <> 'dependency'"), 12, say(F.lit("surface source must be a dependency: "), F.col("source"))),
        found(checked.where((F.col("source_role") == "dependency") & ~F.col("source_for").eqNullSafe(F.col("id"))), 13, say(F.lit("surface source must serve this provider: "), F.col("source"))),
        found(kinds.where(~F.col("kind").isin(*SOURCE_KINDS)), 14, say(F.lit("no adapter for source kind "), F.col("kind"))),
    ]
    return reduce(DataFrame.unionByName, out)


def require_valid(config: DataFrame) -> DataFrame:
    """The config, or an error that names its first violation."""
    places = config.groupBy(F.col("id").alias("provider_id")).agg(F.min("ord").alias("ord"))
    no = F.col("check_no")
    order = [no != 1, F.col("ord"), F.when(no.between(11, 13), 11).otherwise(no), F.col("pos"), no, F.col("message")]
    first = _placed(config).join(places, "provider_id").orderBy(*order).first()
    if first:
        raise ValueError(f"provider {first.provider_id}: {first.message}")
    return config
