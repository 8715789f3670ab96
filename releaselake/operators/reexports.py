"""Composition of a facade's public surface from the measured surfaces of its layers.

Re-export lines are parsed once for each distinct text, resolved to leaves by joins, and walked depth-first: by one task for each facade release, or in
joins over all of them where a facade is very large. What a leaf selects is found by an equality join on those path prefixes that any leaf
names, so that items are read once, are not exploded further, and are never compared one by one.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.items import USE, is_use, item_name, joined_gates, name_prefixes, renamed
from ..sources.shared import materialize
from .hashing import surface_hashes

PARSED = "struct<prefix:array<string>,gates:array<string>,leaves:array<struct<path:array<string>,glob:boolean,name:string,alias:string>>>"
_OPEN = re.compile(r"\s*#\s*\[")
_PIECE = re.compile(r'"(?:\\.|[^"\\])*"?|\[|\]|[^"\[\]]+', re.S)
_WORD = re.compile(r"::|[{},*]|[^\s{},*:]+|:")


def parse_use(text: str) -> dict:
    """Module prefix, cfg gates and leaves of a canonical re-export line; other lines have no leaves."""
    gates, at = [], 0
    while m := _OPEN.match(text, at):
        depth, inner, at = 1, [], m.end()
        while depth and (p := _PIECE.match(text, at)):
            depth += {"[": 1, "]": -1}.get(p[0], 0)
            inner.append(p[0] if depth else "")
            at = p.end()
        gate = "".join(inner).strip()
        gates += [gate] if gate.startswith("cfg") else []
    module, found, line = text[at:].strip().partition("pub use ")
    module = module.strip()
    if not found or (module and not module.endswith("::")):
        return {"prefix": [], "gates": gates, "leaves": []}
    return {"prefix": [p for p in module.split("::") if p], "gates": gates, "leaves": _leaves(line)}


def _leaves(line: str) -> list[dict]:
    out: list[dict] = []
    bases: list[list[str]] = [[]]
    segments: list[str] = []
    alias, naming = None, False

    def end() -> None:
        nonlocal alias, naming
        if segments:
            out.append({"path": bases[-1] + segments[:-1], "glob": False, "name": segments[-1], "alias": alias})
        segments.clear()
        alias, naming = None, False

    for word in _WORD.findall(line.strip().removesuffix(";")):
        if word == "{":
            bases.append(bases[-1] + segments)
            segments.clear()
        elif word in ",}":
            end()
            if word == "}" and len(bases) > 1:
                bases.pop()
        elif word == "*":
            out.append({"path": bases[-1] + segments, "glob": True, "name": None, "alias": None})
            segments.clear()
        elif word == "as" and segments:
            naming = True
        elif naming:
            alias, naming = word, False
        elif word not in ("::", ":"):
            segments.append(word)
    end()
    return out


def _parsed(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([parse_use(t) for t in texts], columns=["prefix", "gates", "leaves"])


def parsed_uses(items: DataFrame) -> DataFrame:
    """key, prefix, gates, leaves of the distinct re-export lines among ``items(key)``."""
    lines = items.where(is_use(F.col("key"))).select("key").distinct()
    return lines.withColumn("use", F.pandas_udf(_parsed, PARSED)(F.substring("key", len(USE) + 1, 1 << 30))).select("key", "use.*")


def leaf_rows(items: DataFrame) -> DataFrame:
    """package, vers, pos, leaf_no, prefix, gates, path, glob, name, alias: a row for each leaf of each re-export line."""
    lines = items.where(is_use(F.col("key"))).select("package", "vers", "pos", "key")
    out = lines.join(parsed_uses(items), "key").select("package", "vers", "pos", "prefix", "gates", F.posexplode("leaves").alias("leaf_no", "leaf"))
    return out.select("package", "vers", "pos", "leaf_no", "prefix", "gates", "leaf.*")


def _joined(path: Column, *more: Column) -> Column:
    return F.array_join(F.concat(path, F.array(*more).cast("array<string>")), "::")


def resolved_leaves(items: DataFrame, measured: DataFrame, graph: DataFrame, facades: DataFrame, aliases: DataFrame) -> DataFrame:
    """Leaves in the view of each facade, with what they point at.

    ``measured(package, vers)``, ``graph(facade_id, lib_name, package)``, ``facades(facade_id, package)``, ``aliases(package, vers, name)``. Adds target
    (package), is_measured, external (a normal dependency of the line's crate), module (the path selected within the target), whole (a module or glob) and is_module."""
    scope = graph.select("facade_id", "package").unionByName(facades.select("facade_id", "package")).distinct()
    whole = F.col("glob") | F.col("name").isNull() | (F.col("name") == "self")
    inner = F.slice("path", 2, 1 << 20)
    leaves = leaf_rows(items).join(scope, "package")
    leaves = leaves.withColumn("lib", F.get("path", 0)).withColumn("module", F.when(whole, _joined(inner)).otherwise(_joined(inner, F.col("name")))).withColumn("whole", whole)
    leaves = leaves.join(graph.select("facade_id", F.col("lib_name").alias("lib"), F.col("package").alias("target")), ["facade_id", "lib"], "left")
    leaves = found = materialize(leaves, "leaves")
    there = measured.select(F.col("package").alias("target"), "vers").join(found.select("target", "vers").distinct(), ["target", "vers"], "left_semi").distinct().withColumn("_measured", F.lit(True))
    leaves = leaves.join(there, ["target", "vers"], "left").withColumn("is_measured", F.coalesce("_measured", F.lit(False))).drop("_measured")
    asked = found.select("package", "vers", "lib").distinct()  # few of the dependencies are named by a line
    names = aliases.select("package", "vers", F.col("name").alias("lib")).join(asked, ["package", "vers", "lib"], "left_semi").distinct().withColumn("_external", F.lit(True))
    leaves = leaves.join(names, ["package", "vers", "lib"], "left").withColumn("external", F.coalesce("_external", F.lit(False))).drop("_external")
    named = found.where(~F.col("whole") & F.col("target").isNotNull()).select(F.col("target").alias("package"), "vers", "module")
    inside = _with_wanted(items.select("package", "vers", "key"), named, name_prefixes(item_name(F.col("key")), proper=True))
    modules = inside.select(F.col("package").alias("target"), "vers", "module").distinct().withColumn("_module", F.lit(True))
    leaves = leaves.join(modules, ["target", "vers", "module"], "left")
    return leaves.withColumn("is_module", F.col("whole") | F.coalesce("_module", F.lit(False))).drop("_module")


def _with_wanted(items: DataFrame, wanted: DataFrame, paths: Column) -> DataFrame:
    """Items (no lines) with ``module``, a row for each of their ``paths`` that ``wanted(package, vers, module)`` has for their release.

    The names wanted of a release travel with it as one array, which is as long as the leaves that point into it."""
    of_release = wanted.distinct().groupBy("package", "vers").agg(F.collect_set("module").alias("_wanted"))
    near = items.where(~is_use(F.col("key"))).join(of_release, ["package", "vers"])
    return near.withColumn("module", F.explode(F.array_intersect(paths, F.col("_wanted")))).drop("_wanted")


VISIT = "facade_id string, vers string, visit_ord int, root boolean, glob boolean, target string, module string, alias string, gates array<string>, unresolved string"


class Leaf(NamedTuple):
    facade_id: str
    vers: str
    facade_package: str
    package: str
    lib: str | None
    path: list[str]
    prefix: list[str]
    gates: list[str]
    glob: bool
    alias: str | None
    target: str | None
    module: str
    is_measured: bool
    external: bool
    is_module: bool


def _walk(rows: list[Leaf]) -> list[tuple]:
    """Depth-first over one facade release's leaf rows, each package's in line order: (root, glob, target, module, alias, gates, unresolved)."""
    lines = defaultdict(list)
    for r in rows:
        lines[r.package].append(r)
    facade_package = rows[0].facade_package
    out: list[tuple] = []
    entered: set[tuple[str, str]] = set()
    todo = [(iter(lines[facade_package]), frozenset(), True)]
    while todo:
        leaves, gates, root = todo[-1]
        leaf = next(leaves, None)
        if leaf is None:
            todo.pop()
            continue
        if not len(leaf.path) or leaf.alias == "_":
            continue
        if len(leaf.prefix):
            if leaf.target is not None:
                out.append((root, False, None, None, None, [], f"{leaf.lib} (module-scoped re-export)"))
            continue
        if leaf.target is None:
            if leaf.external:
                out.append((root, False, None, None, None, [], f"{leaf.lib} (external crate)"))
            continue
        if not leaf.is_measured:
            out.append((root, False, None, None, None, [], f"{leaf.target}@{leaf.vers} (not measured)"))
            continue
        held = gates | set(leaf.gates)
        out.append((root, bool(leaf.glob), leaf.target, leaf.module, leaf.alias, sorted(held), None))
        if leaf.is_module and (leaf.target, leaf.module) not in entered:
            entered.add((leaf.target, leaf.module))
            path = leaf.module.split("::") if leaf.module else []
            below = [x for x in lines[leaf.target] if list(x.prefix[: len(path)]) == path]
            todo.append((iter(below), held, False))
    return out


def visits(leaves: DataFrame, facades: DataFrame) -> DataFrame:
    """What each facade release reaches, in depth-first order: selections of layer items and unresolved boundaries.

    A group holds the leaf rows of one facade release, a few hundred; each layer module is entered once, with the gates of its first visit."""
    own = leaves.join(facades.select("facade_id", F.col("package").alias("facade_package")), "facade_id")
    dealt = own.repartition("facade_id", "vers").sortWithinPartitions("facade_id", "vers", "package", "pos", "leaf_no").select(*Leaf._fields)
    names = [c.split()[0] for c in VISIT.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Leaf] = []

        def walked() -> list[tuple]:
            return [(held[0].facade_id, held[0].vers, i, *v) for i, v in enumerate(_walk(held))] if held else []

        for batch in batches:
            out = []
            for values in zip(*(batch.column(c).to_pylist() for c in Leaf._fields)):
                leaf = Leaf(*values)
                if held and (held[0].facade_id, held[0].vers) != (leaf.facade_id, leaf.vers):
                    out += walked()
                    held = []
                held.append(leaf)
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
        if out := walked():
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    return dealt.mapInArrow(run, VISIT)


LABEL = ["facade_id", "vers", "package", "module"]
WALKED = 200_000  # leaf rows of a facade release up to which one task walks it


def visits_in_rounds(leaves: DataFrame, facades: DataFrame) -> DataFrame:
    """What ``visits`` gives, for facades of any size; ``visit_ord`` is the path of leaves that leads there, whose order is the depth-first one.

    A depth-first walk enters a module by the least path of leaves that leads there, where a path is less than what prolongs it. So each round gives every
    module the least of its referrers' paths, prolonged by the leaf that refers, and the gates along it; once a round changes nothing the paths are
    those of the walk, since prolonging makes a path greater and the least of all are settled first. No group is gathered anywhere."""
    rows = leaves.join(facades.select("facade_id", F.col("package").alias("facade_package")), "facade_id").where("size(path) > 0 and not (alias <=> '_')")
    rows = materialize(rows.withColumn("at", F.struct("pos", "leaf_no")), "rows")
    paths = F.array().cast(f"array<{rows.schema['at'].dataType.simpleString()}>")
    plain = F.size("prefix") == 0
    roots = rows.select("facade_id", "vers", F.col("facade_package").alias("package")).distinct().select("facade_id", "vers", "package", F.lit("").alias("module"), F.lit(True).alias("root"), paths.alias("path"), F.array().cast("array<string>").alias("held"))
    follow = rows.where(plain & F.col("target").isNotNull() & F.col("is_measured") & F.col("is_module")).select("facade_id", "vers", "package", F.col("target").alias("_target"), F.col("module").alias("_module"), "at", "gates")
    entered = roots.where("false")
    while True:
        open_ = roots.unionByName(entered.where("module = ''")).select("facade_id", "vers", "package", "path", "held")
        ahead = open_.join(follow, ["facade_id", "vers", "package"]).select("facade_id", "vers", F.col("_target").alias("package"), F.col("_module").alias("module"), F.concat("path", F.array("at")).alias("path"), joined_gates(F.col("held"), F.col("gates")).alias("held"))
        best = ahead.groupBy(*LABEL).agg(F.min(F.struct("path", "held")).alias("b"))
        now = materialize(best.select(*LABEL, F.lit(False).alias("root"), "b.path", "b.held"), "entered")
        same = now.select(*LABEL, "path").exceptAll(entered.select(*LABEL, "path")).isEmpty() and entered.count() == now.count()
        entered = now
        if same:
            break
    below = F.concat(F.array(F.lit("")), F.transform(F.when(plain, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.size("prefix"))), lambda n: F.array_join(F.slice("prefix", 1, n), "::")))
    scoped = rows.withColumnsRenamed({"path": "_path", "module": "_module"}).withColumn("module", F.explode(below))
    seen = scoped.join(roots.unionByName(entered), LABEL)
    why = (
        F.when(~plain, F.when(F.col("target").isNotNull(), F.concat("lib", F.lit(" (module-scoped re-export)")))).when(F.col("target").isNull(), F.when(F.col("external"), F.concat("lib", F.lit(" (external crate)"))))
        .when(~F.col("is_measured"), F.concat("target", F.lit("@"), "vers", F.lit(" (not measured)")))
    )
    chosen = plain & F.col("target").isNotNull() & F.col("is_measured")
    only = lambda c: F.when(chosen, c)
    out = seen.withColumn("unresolved", why).where(chosen | F.col("unresolved").isNotNull())
    none = F.array().cast("array<string>")
    return out.select(
        "facade_id", "vers", F.concat("path", F.array("at")).alias("visit_ord"), "root", (chosen & F.col("glob")).alias("glob"), only(F.col("target")).alias("target"), only(F.col("_module")).alias("module"), only(F.col("alias")).alias("alias"),
        F.coalesce(only(joined_gates(F.col("held"), F.col("gates"))), none).alias("gates"), "unresolved",
    )


def visited(leaves: DataFrame, facades: DataFrame, most: int = WALKED) -> DataFrame:
    """``visits``, or ``visits_in_rounds`` where some facade release has more than ``most`` leaf rows; ``leaves`` should be cheap to read twice."""
    largest = leaves.groupBy("facade_id", "vers").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    return visits(leaves, facades) if largest <= most else visits_in_rounds(leaves, facades)


def projected(items: DataFrame, visited: DataFrame) -> DataFrame:
    """Layer items that the visits select, renamed and with their gates joined: facade_id, vers, visit_ord, pos, key, digest, cfg, from_package."""
    chosen = visited.where("target is not null").select("facade_id", "vers", "visit_ord", F.col("target").alias("package"), "module", F.col("alias").alias("as_name"), "gates")
    paths = F.concat(F.array(F.lit("")), name_prefixes(item_name(F.col("key"))))
    part = chosen.join(_with_wanted(items.select("package", "vers", "pos", "key", "digest", "cfg"), chosen.select("package", "vers", "module"), paths), ["package", "vers", "module"])
    key = F.when(F.col("module") == "", F.col("key")).otherwise(renamed(F.col("key"), F.col("module"), F.col("as_name")))
    return part.select("facade_id", "vers", "visit_ord", "pos", key.alias("key"), "digest", joined_gates(F.col("gates"), F.col("cfg")).alias("cfg"), F.col("package").alias("from_package"))


def facade_surface(items: DataFrame, facades: DataFrame, visited: DataFrame) -> DataFrame:
    """The composed surface: own items, own lines and projected items, each (key, digest, cfg) once, the first in that order with its other columns (texts, docs,
    members), but for the ``src`` of a projected one, which names a place in another package; own cfg stays as given.

    The first is the least place, a combinable aggregate of narrow rows; other columns join it afterwards by package, release and ``pos``, which is unique in a release."""
    rest = [c for c in items.columns if c not in ("package", "vers", "pos", "key", "digest", "cfg")]
    none = F.lit(None).cast(visited.schema["visit_ord"].dataType)
    own = items.join(facades, "package").select("facade_id", "vers", "key", "digest", "cfg", F.struct(F.when(is_use(F.col("key")), 1).otherwise(0).alias("origin"), none.alias("visit_ord"), "pos", "package").alias("place"))
    added = projected(items, visited).select("facade_id", "vers", "key", "digest", "cfg", F.struct(F.lit(2).alias("origin"), "visit_ord", "pos", F.col("from_package").alias("package")).alias("place"))
    kept = own.unionByName(added).groupBy("facade_id", "vers", "key", "digest", "cfg").agg(F.min("place").alias("place"))
    projected_from = F.when(F.col("place.origin") == 2, F.col("place.package")).alias("from_package")
    if not rest:
        return kept.select("facade_id", "vers", "key", "digest", "cfg", projected_from)
    wide = kept.select("facade_id", "vers", "key", "digest", "cfg", projected_from, F.col("place.package").alias("_package"), F.col("place.pos").alias("_pos"))
    payload = items.select(F.col("package").alias("_package"), "vers", F.col("pos").alias("_pos"), *rest)
    only_own = lambda c: F.when(F.col("from_package").isNull(), F.col(c)).alias(c) if c == "src" else F.col(c)
    return wide.join(payload, ["_package", "vers", "_pos"]).select("facade_id", "vers", "key", "digest", "cfg", "from_package", *(only_own(c) for c in rest))


def source_report(declared: DataFrame, visited: DataFrame, measured: DataFrame, releases: DataFrame) -> DataFrame:
    """How each declared source of a facade release was used: glob, filtered, transitive, unreferenced or missing. ``declared(facade_id, ord, package)``."""
    used = visited.where("target is not null").groupBy("facade_id", "vers", F.col("target").alias("package")).agg(F.bool_or(F.col("root") & F.col("glob")).alias("_glob"), F.bool_or("root").alias("_root"))
    rows = declared.join(releases.select("facade_id", "vers").distinct(), "facade_id")
    out = rows.join(used, ["facade_id", "vers", "package"], "left").join(measured.select("package", "vers", F.lit(True).alias("_measured")).distinct(), ["package", "vers"], "left")
    mode = F.when(F.col("_glob"), "glob").when(F.col("_root"), "filtered").when(F.col("_root").isNotNull(), "transitive").when(F.col("_measured"), "unreferenced").otherwise("missing")
    return out.select("facade_id", "vers", "ord", "package", mode.alias("mode"))


def unresolved(visited: DataFrame) -> DataFrame:
    return visited.where("unresolved is not null").select("facade_id", "vers", F.col("unresolved").alias("boundary")).distinct()


def compositions(items: DataFrame, facades: DataFrame, surface: DataFrame) -> DataFrame:
    """facade_id, vers, own, items, added, api_hash of each facade release; the hash stands only where something was added."""
    own = items.join(facades, "package").groupBy("facade_id", "vers").agg(F.count("*").alias("own"))
    made = surface_hashes(surface, ["facade_id", "vers"]).withColumnRenamed("api_hash", "hash")
    added = F.col("items") - F.col("own")
    return own.join(made, ["facade_id", "vers"]).select("facade_id", "vers", "own", "items", added.alias("added"), F.when(added != 0, F.col("hash")).alias("api_hash"))


def provenance(composed: DataFrame, report: DataFrame, boundaries: DataFrame, kind: str = "reexports") -> DataFrame:
    """facade_id, vers, composed_surface struct<kind, sources, items_added, unresolved> of releases that a composition changed; sources in declared order, boundaries sorted.

    ``report`` as ``source_report`` gives it, ``boundaries`` as ``unresolved`` does."""
    sources = report.groupBy("facade_id", "vers").agg(F.array_sort(F.collect_list(F.struct("ord", "package", "vers", "mode"))).alias("_sources"))
    missing = boundaries.groupBy("facade_id", "vers").agg(F.array_sort(F.collect_set("boundary")).alias("_unresolved"))
    out = composed.where("added <> 0").select("facade_id", "vers", "added").join(sources, ["facade_id", "vers"], "left").join(missing, ["facade_id", "vers"], "left")
    plain = F.transform(F.coalesce("_sources", F.array().cast(sources.schema["_sources"].dataType)), lambda s: F.struct(s["package"].alias("package"), s["vers"].alias("vers"), s["mode"].alias("mode")))
    none = F.array().cast("array<string>")
    record = F.struct(F.lit(kind).alias("kind"), plain.alias("sources"), F.col("added").alias("items_added"), F.coalesce("_unresolved", none).alias("unresolved"))
    return out.select("facade_id", "vers", record.alias("composed_surface"))


def compose(versions: DataFrame, composed: DataFrame, origin: DataFrame | None = None) -> DataFrame:
    """Dataset versions with the composed hash in place of the measured one where a composition added items, and with its provenance if given."""
    new = composed.where("added <> 0").select(F.col("facade_id").alias("provider_id"), "vers", F.col("api_hash").alias("_hash"), "added")
    out = versions.join(new, ["provider_id", "vers"], "left").withColumn("api_hash", F.coalesce("_hash", "api_hash")).withColumn("items_added", F.col("added")).drop("_hash", "added")
    return out if origin is None else out.join(origin.withColumnRenamed("facade_id", "provider_id"), ["provider_id", "vers"], "left")
