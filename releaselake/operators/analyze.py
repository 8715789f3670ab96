"""Comparisons of releases: what changed, what is equal, what still fits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.versions import semver_key


def dependency_stats(deps: DataFrame) -> DataFrame:
    """edges, names, shared_edges: direct dependencies, their distinct names, and the edges whose (name, req) several releases have.

    Pre-aggregated by (name, req), so that a name that most releases depend on is no hot key."""
    per = deps.groupBy("name", "req").agg(F.count("*").alias("n"), F.countDistinct("package", "vers").alias("releases"))
    return per.agg(F.sum("n").alias("edges"), F.countDistinct("name").alias("names"), F.coalesce(F.sum(F.when(F.col("releases") > 1, F.col("n"))), F.lit(0)).alias("shared_edges"))


PRECISION = 14  # of the sketches: 2 ** 14 registers, a standard error of some 0.8 %


def dependency_sketches(deps: DataFrame, by: list[str]) -> DataFrame:
    """``by``, edges, and mergeable sketches of the distinct names, requirements (name, req) and depending releases of each batch of dependencies."""
    sketch = lambda *c: F.hll_sketch_agg(F.concat_ws("\0", *c), F.lit(PRECISION))
    return deps.groupBy(*by).agg(F.count("*").alias("edges"), sketch("name").alias("names"), sketch("name", "req").alias("requirements"), sketch("package", "vers").alias("dependents"))


def merged_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The sketches of several batches as those of one; batches may overlap in names, but a dependency is counted in one alone."""
    union = lambda c: F.hll_union_agg(c).alias(c)
    return sketches.groupBy(*(by or [])).agg(F.sum("edges").alias("edges"), union("names"), union("requirements"), union("dependents"))


def sketched_stats(merged: DataFrame) -> DataFrame:
    """edges, which are exact, and the estimated distinct names, requirements and dependents."""
    return merged.withColumns({c: F.hll_sketch_estimate(c) for c in ("names", "requirements", "dependents")})


def generation_classes(hashes: DataFrame) -> DataFrame:
    """Releases with one api_hash: how many, of how many packages, lowest and highest version, and whether it has twins in another package. Unmeasured releases are in no class."""
    key = semver_key(F.col("vers"))
    out = hashes.where("api_hash is not null").groupBy("api_hash").agg(
        F.count("*").alias("members"), F.countDistinct("package").alias("packages"), F.min_by("vers", F.struct(key, F.col("vers"))).alias("lowest"), F.max_by("vers", F.struct(key, F.col("vers"))).alias("highest"),
    )
    return out.withColumn("twins", F.col("packages") > 1)


def with_neighbours(releases: DataFrame) -> DataFrame:
    """package, vers, prev_vers, next_vers in version order."""
    w = Window.partitionBy("package").orderBy(semver_key(F.col("vers")), "vers")
    return releases.select("package", "vers").distinct().select("package", "vers", F.lag("vers").over(w).alias("prev_vers"), F.lead("vers").over(w).alias("next_vers"))


def beside_next(items: DataFrame, releases: DataFrame) -> DataFrame:
    """``items(package, vers, key, digest, cfg, ...)``, each key once in a release, with next_vers (null in a package's last release) and what that release has under
    the same key: next_there, next_digest, next_cfg; and with is_first and is_last, whether the key is the least or the greatest of its release.

    Versions come as one list a package. All steps group or join by the package or by it and more, so that items already dealt by the package are not shuffled again."""
    order = F.array_sort(F.collect_set(F.struct(semver_key(F.col("vers")).alias("at"), "vers")))
    history = releases.select("package", "vers").distinct().groupBy("package").agg(F.transform(order, lambda r: r["vers"]).alias("_history"))
    at = F.array_position("_history", F.col("vers"))
    out = items.join(history, "package").withColumns({"_at": at, "next_vers": F.get("_history", at.cast("int"))}).drop("_history")
    w, release = Window.partitionBy("package", "key").orderBy("_at"), Window.partitionBy("package", "vers")
    there = F.col("key").isNotNull() & F.coalesce(F.lead("_at").over(w) == F.col("_at") + 1, F.lit(False))
    out = out.withColumns({"next_there": there, "next_digest": F.lead("digest").over(w), "next_cfg": F.lead("cfg").over(w)})
    out = out.withColumns({c: F.when(F.col("next_there"), F.col(c)) for c in ("next_digest", "next_cfg")})
    ends = {"is_first": F.min("key").over(release), "is_last": F.max("key").over(release)}
    return out.withColumns({c: F.coalesce(F.col("key") == end, F.lit(False)) for c, end in ends.items()}).drop("_at")


def release_delta(items: DataFrame, releases: DataFrame) -> DataFrame:
    """package, vers, key, change against the release before: added, removed, re-signed (other digest) or regated (other cfg).

    ``items(package, vers, key, digest, cfg)`` has each key once in a release. Each item is sent to its own release and to the next
    one, where both meet by key; nothing is compared pairwise."""
    near = with_neighbours(releases)
    mine = items.join(near.select("package", "vers", "prev_vers"), ["package", "vers"]).where("prev_vers is not null").select("package", "vers", "key", F.struct("digest", "cfg").alias("now"), F.lit(None).cast(_side(items)).alias("was"))
    before = items.join(near.select("package", "vers", "next_vers"), ["package", "vers"]).where("next_vers is not null").select("package", F.col("next_vers").alias("vers"), "key", F.lit(None).cast(_side(items)).alias("now"), F.struct("digest", "cfg").alias("was"))
    both = mine.unionByName(before).groupBy("package", "vers", "key").agg(F.max("now").alias("now"), F.max("was").alias("was"))
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(~F.col("now.digest").eqNullSafe(F.col("was.digest")), "re-signed").when(~F.col("now.cfg").eqNullSafe(F.col("was.cfg")), "regated")
    return both.withColumn("change", change).where("change is not null").select("package", "vers", "key", "change")


def _side(items: DataFrame) -> str:
    kinds = dict(items.dtypes)
    return f"struct<digest:{kinds['digest']},cfg:{kinds['cfg']}>"


def first_removed(delta: DataFrame) -> DataFrame:
    """package, key, vers: the first release that removed a key."""
    return delta.where("change = 'removed'").groupBy("package", "key").agg(F.min_by("vers", F.struct(semver_key(F.col("vers")), F.col("vers"))).alias("vers"))


def trait_breaks(surfaces: DataFrame) -> DataFrame:
    """Releases that dropped traits while their surface stayed equal: ``surfaces(package, vers, api_hash, traits)``, traits as ``type: trait`` strings."""
    w = Window.partitionBy("package").orderBy(semver_key(F.col("vers")), "vers")
    out = surfaces.withColumn("_hash", F.lag("api_hash").over(w)).withColumn("_traits", F.lag("traits").over(w))
    lost = F.array_sort(F.array_except("_traits", "traits"))
    return out.where("_hash = api_hash").withColumn("lost", lost).where("size(lost) > 0").select("package", "vers", "lost")


def used_api_report(used: DataFrame, items: DataFrame, baseline: DataFrame) -> DataFrame:
    """package, vers, checkable, unprovable, intact, missing, resigned, compatible for every release of a baseline's package.

    ``used(package, key)``, ``items(package, vers, key, digest)``, ``baseline(package, vers)``. Symbols that the baseline lacks are unprovable; a
    release is compatible if every checkable symbol has the baseline's digest there."""
    have = items.select("package", "vers", "key", "digest").distinct()
    wanted = have.join(used.select("package", "key").distinct(), ["package", "key"], "left_semi")
    base = wanted.join(baseline, ["package", "vers"], "left_semi").groupBy("package", "key").agg(F.min("digest").alias("base"))
    counts = used.select("package", "key").distinct().join(base, ["package", "key"], "left").groupBy("package").agg(F.count("base").alias("checkable"), F.count_if(F.col("base").isNull()).alias("unprovable"))
    seen = wanted.groupBy("package", "vers", "key").agg(F.min("digest").alias("digest")).join(base, ["package", "key"])
    per = seen.groupBy("package", "vers").agg(F.count_if(F.col("digest") == F.col("base")).alias("_intact"), F.count("*").alias("_seen"))
    rows = items.select("package", "vers").distinct().join(counts, "package").join(per, ["package", "vers"], "left")
    intact, there = F.coalesce("_intact", F.lit(0)), F.coalesce("_seen", F.lit(0))
    out = rows.select("package", "vers", "checkable", "unprovable", intact.alias("intact"), (F.col("checkable") - there).alias("missing"), (there - intact).alias("resigned"))
    return out.withColumn("compatible", F.col("intact") == F.col("checkable"))


def compatible_window(report: DataFrame, baseline: DataFrame) -> DataFrame:
    """package, first, last, releases: the unbroken run of compatible releases around the baseline, in version order."""
    order = [semver_key(F.col("vers")), F.col("vers")]
    w = Window.partitionBy("package").orderBy(*order)
    runs = report.withColumn("_run", F.sum(F.when(F.col("compatible"), 0).otherwise(1)).over(w)).where("compatible")
    mine = runs.join(baseline, ["package", "vers"], "left_semi").select("package", "_run").distinct()
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)])
    return runs.join(mine, ["package", "_run"], "left_semi").groupBy("package").agg(F.min_by("vers", key).alias("first"), F.max_by("vers", key).alias("last"), F.count("*").alias("releases"))


def plan_action(same: Column, to_key: Column) -> Column:
    return F.when(same, "keep").when(to_key.isNotNull(), "rewrite").otherwise("manual")


def migration_plan(used: DataFrame, before: DataFrame, after: DataFrame, rules: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """key, action, to_key for symbols used from the old surface: keep if unchanged, rewrite if a rule applies, else manual. Surfaces are (key, digest); ``rules(from_key, to_key, status)``.

    All four inputs also have the columns ``by``, which name one plan of many; they lead the result."""
    on = [*by, "key"]
    old = before.groupBy(*on).agg(F.min("digest").alias("_old"))
    new = after.groupBy(*on).agg(F.min("digest").alias("_new"))
    ready = rules.where("status = 'applies'").groupBy(*by, F.col("from_key").alias("key")).agg(F.min("to_key").alias("to_key"))
    out = used.select(*on).distinct().join(old, on).join(new, on, "left").join(ready, on, "left")
    action = plan_action(F.col("_old") == F.col("_new"), F.col("to_key"))
    return out.select(*on, action.alias("action"), F.when(action == "rewrite", F.col("to_key")).alias("to_key"))


def workspace_audit(locks: DataFrame, apps: DataFrame, generations: DataFrame) -> DataFrame:
    """workspace, matches, same_generation, clashes, unverifiable, refused.

    ``locks(workspace, package, vers)``, ``apps(workspace, package, vers)`` (the app's own binding), ``generations(package, vers, api_hash)`` of fork packages, which
    alone are judged. A workspace that locks more than one fork package is refused."""
    forks = generations.select("package").distinct()
    mine = locks.join(forks, "package", "left_semi").distinct().join(generations, ["package", "vers"], "left")
    app = apps.select("workspace", F.col("package").alias("_package"), F.col("vers").alias("_vers")).join(generations.select(F.col("package").alias("_package"), F.col("vers").alias("_vers"), F.col("api_hash").alias("_hash")), ["_package", "_vers"], "left")
    out = mine.join(app, "workspace")
    same = (F.col("package") == F.col("_package")) & (F.col("vers") == F.col("_vers"))
    verdict = F.when(same, "match").when(F.col("api_hash").isNull() | F.col("_hash").isNull(), "unverifiable").when(F.col("api_hash") == F.col("_hash"), "same").otherwise("clash")
    n = lambda v: F.count_if(F.col("_verdict") == v)
    return out.withColumn("_verdict", verdict).groupBy("workspace").agg(n("match").alias("matches"), n("same").alias("same_generation"), n("clash").alias("clashes"), n("unverifiable").alias("unverifiable"), (F.countDistinct("package") > 1).alias("refused"))


