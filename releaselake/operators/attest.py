"""Which recorded measurements still hold, and what the next record is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.versions import installed_toolchain, padded, plain_key
from .keep import keep_last

DOC_KINDS = ("tvm", "eac")
ENVIRONMENT = ("tool", "rustc", "rustdoc")


def usable_entries(entries: DataFrame, current: DataFrame, schema: str | None = None) -> DataFrame:
    """The entries whose own ``environment`` equals the one current in full (nulls are unknown and never equal), without that column and their schema tag.

    Where ``schema`` is given, an entry's ``schema`` must be that."""
    now = F.broadcast(current.limit(1).select(F.struct(*(F.col(c).alias(c) for c in ENVIRONMENT)).alias("_now")))
    held = entries if schema is None else entries.where(F.col("schema") == schema)
    out = held.crossJoin(now)
    for c in ENVIRONMENT:
        out = out.where(F.col(f"environment.{c}") == F.col(f"_now.{c}"))
    return out.drop("_now", "environment", "schema")


def environment_note(rows: DataFrame) -> DataFrame:
    """``rows`` with ``note``: every component that moved between the structs ``recorded`` and ``current``, the tool first, its digests shortened."""

    def moved(c: str) -> Column:
        was, now = (F.coalesce(F.col(side)[c], F.lit("unknown")) for side in ("recorded", "current"))
        was, now = (F.substring(x, 1, 12) if c == "tool" else x for x in (was, now))
        return F.when(~F.col("recorded")[c].eqNullSafe(F.col("current")[c]), F.concat(F.lit(f"{c} changed ("), was, F.lit(" → "), now, F.lit(")")))

    note = F.concat_ws("; ", *(moved(c) for c in ENVIRONMENT))
    return rows.withColumn("note", F.when(note == "", "the recorded environment differs").otherwise(note))


def intact_docs(entries: DataFrame, docs: DataFrame) -> DataFrame:
    """package, vers of entries whose documents of both kinds have the recorded digest and schema. ``docs(kind, package, vers, sha256, schema)``."""
    out = entries
    for k in DOC_KINDS:
        d = docs.where(F.col("kind") == k).select("package", "vers", F.col("sha256").alias("_sha"), F.col("schema").alias("_schema"))
        out = out.join(d, ["package", "vers"]).where((F.col(f"{k}.sha256") == F.col("_sha")) & (F.col(f"{k}.schema") == F.col("_schema"))).drop("_sha", "_schema")
    return out.select("package", "vers")


def installed_toolchains(lines: DataFrame, by: list[str] | None = None) -> DataFrame:
    """version, name of ``lines(ord, line)`` of installed toolchains; of those of one version the last counts. ``by`` names further columns that tell one list from another."""
    by = by or []
    found = lines.select(*by, "ord", installed_toolchain(F.col("line")).alias("t")).where("t is not null").select(*by, "ord", "t.*")
    return keep_last(found, [*by, "version"], "ord").select(*by, "version", "name")


def floors(releases: DataFrame, installed: DataFrame, active: str | Column | None) -> DataFrame:
    """``attempt`` (the installed toolchain of the declared version) or ``missing`` (its version). Nothing to do if the declaration is unreadable,
    not below the active compiler, or that is unknown. ``installed(version, name)``, the last of equal versions having been kept."""
    now = plain_key(F.lit(active) if not isinstance(active, Column) else active)
    want = padded(F.col("rust_version"))
    out = releases.withColumn("_want", want).join(installed.select(F.col("version").alias("_want"), F.col("name").alias("_name")), "_want", "left")
    older = plain_key(F.col("_want")) < now
    return out.withColumn("attempt", F.when(older, F.col("_name"))).withColumn("missing", F.when(older & F.col("_name").isNull(), F.col("_want"))).drop("_want", "_name")


def wanted_toolchains(releases: DataFrame, active: str) -> DataFrame:
    """version: the declared versions below the active compiler, once each."""
    want = releases.select(padded(F.col("rust_version")).alias("version")).where("version is not null").distinct()
    return want.where(plain_key(F.col("version")) < plain_key(F.lit(active)))


def floor_advisory(releases: DataFrame, active: str) -> DataFrame:
    """Releases that declare a newer compiler than the active one, with the declaration as written; unreadable ones claim nothing."""
    return releases.where(plain_key(padded(F.col("rust_version"))) > plain_key(F.lit(active)))


def reuse_decisions(built: DataFrame, entries: DataFrame, intact: DataFrame, reuse: bool = True) -> DataFrame:
    """Built releases (package, vers, cksum, lock_now, attempt, missing) with ``reused``, the first ``reason`` against it, and ``keeps_floor``.

    Digests must be known and equal; a null one never matches. A recorded floor whose compiler is not installed now is kept."""
    e = entries.select("package", "vers", F.col("cksum").alias("_cksum"), F.col("lock").alias("_lock"), F.col("floor").alias("_floor"), F.lit(True).alias("_entry"))
    ok = intact.select("package", "vers", F.lit(True).alias("_intact")).distinct()
    out = built.join(e, ["package", "vers"], "left").join(ok, ["package", "vers"], "left")
    keeps = F.col("_floor").isNotNull() & F.col("missing").isNotNull()
    no = lambda c: ~F.coalesce(c, F.lit(False))
    reason = (
        F.when(F.lit(not reuse), "reuse is off")
        .when(F.col("cksum").isNull(), "no checksum")
        .when(F.col("_entry").isNull(), "no entry")
        .when(no(F.col("_cksum") == F.col("cksum")), "checksum moved")
        .when(~(F.col("attempt").eqNullSafe(F.col("_floor")) | keeps), "floor moved")
        .when(F.col("lock_now").isNull(), "no lock")
        .when(no(F.col("_lock") == F.col("lock_now")), "lock moved")
        .when(F.col("_intact").isNull(), "documents moved")
    )
    return out.withColumn("reason", reason).withColumn("reused", F.col("reason").isNull()).withColumn("keeps_floor", F.col("reused") & keeps).drop("_cksum", "_lock", "_floor", "_entry", "_intact")


def carried_failures(failed: DataFrame, entries: DataFrame, intact: DataFrame) -> DataFrame:
    """Entries of releases that failed to build now, kept while their checksum and documents hold, whatever lock, floor and reuse say."""
    return entries.join(failed.select("package", "vers", F.col("cksum").alias("_now")), ["package", "vers"]).where("cksum = _now").drop("_now").join(intact, ["package", "vers"], "left_semi")


def recorded(measured: DataFrame, docs: DataFrame) -> DataFrame:
    """New entries of the releases measured in this run, from this run's documents; without any document there is no entry."""
    one = lambda k: F.max(F.when(F.col("kind") == k, F.struct("sha256", "schema")))
    held = docs.groupBy("package", "vers").agg(*(one(k).alias(k) for k in DOC_KINDS)).where(" or ".join(f"{k} is not null" for k in DOC_KINDS))
    return measured.select("package", "vers", "cksum", F.col("lock_now").alias("lock"), F.col("attempt").alias("floor")).join(held, ["package", "vers"])


def attestation_index(entries: DataFrame, decisions: DataFrame, carried: DataFrame, new: DataFrame) -> DataFrame:
    """The next index: reused entries, kept ones of failed builds, new ones; ``origin`` tells which."""
    kept = entries.join(decisions.where("reused").select("package", "vers"), ["package", "vers"], "left_semi")
    tag = lambda df, what: df.select("package", "vers", "cksum", "lock", "floor", *DOC_KINDS).withColumn("origin", F.lit(what))
    return tag(kept, "reused").unionByName(tag(carried, "kept")).unionByName(tag(new, "measured"))


def pruned_docs(docs: DataFrame, index: DataFrame) -> DataFrame:
    """Documents that the index does not list."""
    listed = index.select("package", "vers", F.explode(F.array(*(F.when(F.col(k).isNotNull(), F.lit(k)) for k in DOC_KINDS))).alias("kind")).where("kind is not null")
    return docs.join(listed, ["kind", "package", "vers"], "left_anti").select("kind", "package", "vers")


def run_summary(decisions: DataFrame) -> DataFrame:
    return decisions.agg(
        F.count_if("reused").alias("reused"), F.count_if(~F.col("reused")).alias("to_measure"), F.count("*").alias("total"), F.count("attempt").alias("floor_candidates"),
        F.array_join(F.array_sort(F.collect_set("missing")), ",").alias("missing"),
    )
