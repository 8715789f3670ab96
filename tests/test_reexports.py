"""Composition over small made-up worlds of ports (facades) and the yards they are built from."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from releaselake.functions.items import surface_hash
from releaselake.operators import hashing, reexports

ITEM = "package string, vers string, pos int, key string, digest string, cfg array<string>"


class World:
    """Packages with their items in order, at one version; ports by id with the packages that their library names stand for."""

    def __init__(self, spark, packages, ports, names, normal=(), parts=3):
        rows = [(p, "2.4.0", i, *item, *([[]] if len(item) == 2 else [])) for p, items in packages.items() for i, item in enumerate(items)]
        self.items = spark.createDataFrame(rows, ITEM).repartition(parts)
        self.facades = spark.createDataFrame(list(ports.items()), "facade_id string, package string")
        self.graph = spark.createDataFrame([(f, lib, p) for f, held in names.items() for lib, p in held.items()], "facade_id string, lib_name string, package string")
        self.measured = self.items.select("package", "vers").distinct()
        self.aliases = spark.createDataFrame([(p, "2.4.0", n) for p, n in normal], "package string, vers string, name string")
        self.leaves = reexports.resolved_leaves(self.items, self.measured, self.graph, self.facades, self.aliases).cache()
        self.visits = reexports.visited(self.leaves, self.facades).cache()
        self.composed = reexports.facade_surface(self.items, self.facades, self.visits).cache()

    def surface(self, port):
        return {(r.key, r.digest, tuple(r.cfg)) for r in self.composed.where(F.col("facade_id") == port).collect()}

    def keys(self, port):
        return {k for k, _, _ in self.surface(port) if not k.startswith("use:")}

    def boundaries(self):
        return {(r.facade_id, r.boundary) for r in reexports.unresolved(self.visits).collect()}

    def report(self, *declared):
        df = self.items.sparkSession.createDataFrame([(f, i, p) for i, (f, p) in enumerate(declared)], "facade_id string, ord int, package string")
        rows = reexports.source_report(df, self.visits, self.measured, self.items.join(self.facades, "package"))
        return {(r.facade_id, r.package): r.mode for r in rows.collect()}


@pytest.mark.parametrize(
    "text, prefix, gates, leaves",
    [
        ('# [cfg (all (unix , feature = "net"))] # [doc = "not a [pub use] line"] pub use yard :: crane :: { Hook , lift :: * , self as deck } ;', [], ['cfg (all (unix , feature = "net"))'],
         [(["yard", "crane"], False, "Hook", None), (["yard", "crane", "lift"], True, None, None), (["yard", "crane"], False, "self", "deck")]),
        ("pub use { ropes :: Knot , sails :: { Jib as Foresail , * } } ;", [], [], [(["ropes"], False, "Knot", None), (["sails"], False, "Jib", "Foresail"), (["sails"], True, None, None)]),
        ("pier::north::pub use super :: Gate as _ ;", ["pier", "north"], [], [(["super"], False, "Gate", "_")]),
        ("pub use Bell ;", [], [], [([], False, "Bell", None)]),
        ('# [deprecated] # [cfg (test)] pub use a :: * ;', [], ["cfg (test)"], [(["a"], True, None, None)]),
        ("fn pub_use ( )", [], [], []),
        ("not a module pub use a :: B ;", [], [], []),
    ],
)
def test_lines_are_parsed(text, prefix, gates, leaves):
    got = reexports.parse_use(text)
    assert (got["prefix"], got["gates"], [(x["path"], x["glob"], x["name"], x["alias"]) for x in got["leaves"]]) == (prefix, gates, leaves)


def test_two_ports_give_one_name_two_meanings(spark):
    packages = {
        "rotterdam": [("use:pub use cranes :: * ;", "1")], "genoa": [("struct:Own", "o"), ("use:pub use cranes :: big :: * ;", "2")],
        "liebherr": [("fn:lift", "l"), ("fn:big::heave", "h")], "gottwald": [("fn:lift", "g"), ("fn:big::swing", "s"), ("fn:bigger::no", "n")],
    }
    w = World(spark, packages, {"r": "rotterdam", "g": "genoa"}, {"r": {"cranes": "liebherr"}, "g": {"cranes": "gottwald"}})
    assert (w.keys("r"), w.keys("g")) == ({"fn:lift", "fn:big::heave"}, {"struct:Own", "fn:big::swing"})
    assert w.report(("r", "liebherr"), ("g", "gottwald"), ("r", "gottwald")) == {("r", "liebherr"): "glob", ("g", "gottwald"): "glob", ("r", "gottwald"): "unreferenced"}


def test_modules_within_modules_and_new_names(spark):
    packages = {
        "port": [("use:pub use hull :: deck :: upper :: Rail as Fence ;", "1"), ("use:pub use hull :: deck :: lower as hold ;", "2"), ("use:pub use hull :: { self as _ } ;", "3")],
        "hull": [("struct:deck::upper::Rail", "r"), ("fn:deck::upper::Rail::paint", "p"), ("fn:deck::upper::Railing", "x"), ("enum:deck::lower::Crate", "c"), ("enum:deck::lower", "e"), ("trait:deck::Walk", "w")],
    }
    w = World(spark, packages, {"p": "port"}, {"p": {"hull": "hull"}})
    assert w.keys("p") == {"struct:Fence", "fn:Fence::paint", "enum:hold::Crate", "enum:hold"}
    assert w.report(("p", "hull")) == {("p", "hull"): "filtered"}


def test_yards_that_refer_to_each_other(spark):
    """Each yard is entered once; what lies behind is reached through two others, and the port itself is a yard of its own."""
    packages = {
        "port": [("fn:own", "o"), ("use:pub use east :: * ;", "1")], "east": [("fn:e", "e"), ("use:pub use west :: * ;", "2"), ("use:pub use me :: * ;", "5")],
        "west": [("fn:w", "w"), ("use:pub use east :: * ;", "3"), ("use:pub use far :: isle :: * ;", "4")], "far": [("fn:isle::palm", "i"), ("fn:reef", "f")],
    }
    w = World(spark, packages, {"p": "port"}, {"p": {"east": "east", "west": "west", "far": "far", "me": "port"}})
    assert w.keys("p") == {"fn:own", "fn:e", "fn:w", "fn:isle::palm"}
    assert w.report(("p", "west"), ("p", "far")) == {("p", "west"): "transitive", ("p", "far"): "transitive"}
    assert w.visits.where("target = 'east'").count() == 3 and not w.boundaries()


@pytest.mark.parametrize("first", ["day", "night"])
def test_the_first_way_into_a_yard_sets_its_gates(spark, first):
    other = "night" if first == "day" else "day"
    line = lambda when: (f'use:# [cfg (feature = "{when}")] pub use shared :: * ;', when)
    packages = {"port": [line(first), line(other)], "shared": [("fn:s", "s", ['cfg (feature = "a")']), ("use:pub use deep :: * ;", "d")], "deep": [("fn:d", "d")]}
    w = World(spark, packages, {"p": "port"}, {"p": {"shared": "shared", "deep": "deep"}})
    gates = {k: {c for key, _, c in w.surface("p") if key == k} for k in ("fn:s", "fn:d")}
    assert gates["fn:d"] == {(f'cfg (feature = "{first}")',)}
    assert gates["fn:s"] == {('cfg (feature = "a")', f'cfg (feature = "{x}")') for x in ("day", "night")}


def test_where_a_walk_ends(spark):
    packages = {
        "port": [("use:pub use dry :: * ;", "1"), ("use:pub use tokio :: Runtime ;", "2"), ("use:pub use mine :: Thing ;", "3"), ("use:dock::pub use wet :: Boat ;", "4"), ("struct:Boat", "b")],
        "wet": [("struct:Boat", "b")], "else": [("use:pub use dry :: * ;", "9")],
    }
    w = World(spark, packages, {"p": "port"}, {"p": {"dry": "dry", "wet": "wet"}}, normal=[("port", "tokio"), ("else", "mine")])
    assert w.boundaries() == {("p", "dry@2.4.0 (not measured)"), ("p", "tokio (external crate)"), ("p", "wet (module-scoped re-export)")}
    assert w.report(("p", "dry"), ("p", "wet")) == {("p", "dry"): "missing", ("p", "wet"): "unreferenced"}
    made = reexports.compositions(w.items, w.facades, w.composed).first()
    assert (made.own, made.items, made.added, made.api_hash) == (5, 5, 0, None)


def test_summary_hash_and_rows_in_any_order(spark):
    packages = {"port": [("use:pub use y :: * ;", "1"), ("fn:b", "b", ["g", "f"])], "y": [("fn:a", "a"), ("fn:b", "b", ["f", "g"]), ("fn:a", "a")]}
    worlds = [World(spark, packages, {"p": "port"}, {"p": {"y": "y"}}, parts=n) for n in (1, 6)]
    assert worlds[0].surface("p") == worlds[1].surface("p") == {("use:pub use y :: * ;", "1", ()), ("fn:b", "b", ("g", "f")), ("fn:b", "b", ("f", "g")), ("fn:a", "a", ())}
    made = reexports.compositions(worlds[1].items, worlds[1].facades, worlds[1].composed).first()
    text = "\0".join(f"{k}\0{d}\0{'|'.join(c)}" for k, d, c in sorted(worlds[0].surface("p")))
    assert (made.own, made.added, made.api_hash) == (2, 2, hashlib.sha256(text.encode()).hexdigest())


def test_a_composition_changes_only_what_gained_items(spark):
    versions = spark.createDataFrame([("p", "1", "was"), ("p", "2", "was"), ("q", "1", None)], "provider_id string, vers string, api_hash string")
    composed = spark.createDataFrame([("p", "1", 4, 9, 5, "is"), ("p", "2", 4, 4, 0, None)], "facade_id string, vers string, own long, items long, added long, api_hash string")
    assert {tuple(r) for r in reexports.compose(versions, composed).select("provider_id", "vers", "api_hash", "items_added").collect()} == {("p", "1", "is", 5), ("p", "2", "was", None), ("q", "1", None, None)}


def test_wide_rows_follow_the_first_of_equal_items(spark):
    """Texts, members and places come from the port's own row if it has one, else from the first yard in the walk; the plan sorts no wide rows in a window."""
    kinds = ITEM + ", text string, members string, src struct<file string, start int>"
    rows = [
        ("port", "1", 0, "fn:x", "d", [], "own x", "m0", ("port.rs", 3)), ("port", "1", 1, "use:pub use y :: * ;", "u", [], "line y", None, None), ("port", "1", 2, "use:pub use z :: * ;", "v", [], "line z", None, None),
        ("z", "1", 0, "fn:both", "d", [], "from z", "mz", ("z.rs", 1)), ("y", "1", 0, "fn:x", "d", [], "their x", "my", ("y.rs", 8)), ("y", "1", 1, "fn:both", "d", [], "from y", "my", ("y.rs", 9)),
    ]
    items = spark.createDataFrame(rows, kinds)
    facades = spark.createDataFrame([("p", "port")], "facade_id string, package string")
    graph = spark.createDataFrame([("p", n, n) for n in "yz"], "facade_id string, lib_name string, package string")
    none = spark.createDataFrame([], "package string, vers string, name string")
    for walk in (reexports.visits, reexports.visits_in_rounds):
        visits = walk(reexports.resolved_leaves(items, items.select("package", "vers").distinct(), graph, facades, none), facades).cache()
        surface = reexports.facade_surface(items, facades, visits)
        got = {(r.key, r.from_package, r.text, r.members, r.src and r.src.file) for r in surface.collect()}
        assert got == {("fn:x", None, "own x", "m0", "port.rs"), ("fn:both", "y", "from y", "my", None), ("use:pub use y :: * ;", None, "line y", None, None), ("use:pub use z :: * ;", None, "line z", None, None)}
        assert "Window" not in surface._jdf.queryExecution().executedPlan().toString()
    declared = spark.createDataFrame([("p", 1, "w"), ("p", 0, "y")], "facade_id string, ord int, package string")
    report = reexports.source_report(declared, visits, items.select("package", "vers"), items.join(facades, "package"))
    made = reexports.provenance(reexports.compositions(items, facades, surface), report, reexports.unresolved(visits)).first().composed_surface
    assert (made.kind, [tuple(s) for s in made.sources], made.items_added, made.unresolved) == ("reexports", [("y", "1", "glob"), ("w", "1", "missing")], 1, [])


def test_only_wanted_prefixes_are_exploded(spark):
    items = spark.createDataFrame([("y", "1", i, f"fn:a::b::c::f{i}", "d", []) for i in range(50)] + [("y", "1", 50, "fn:m::g", "d", [])], ITEM)
    wanted = spark.createDataFrame([("y", "1", "m"), ("y", "1", "a::b"), ("y", "1", "zz"), ("q", "1", "a")], "package string, vers string, module string")
    from releaselake.functions.items import item_name, name_prefixes

    got = reexports._with_wanted(items, wanted, name_prefixes(item_name(F.col("key"))))
    assert got.groupBy("module").count().collect() and {(r.module, r["count"]) for r in got.groupBy("module").count().collect()} == {("a::b", 50), ("m", 1)}


def plain_walk(leaves, port_package):
    """Depth-first, by recursion: (path of leaf places, target, module, alias, gates, unresolved)."""
    of = {}
    for x in sorted(leaves, key=lambda x: (x.package, x.pos, x.leaf_no)):
        of.setdefault(x.package, []).append(x)
    out, entered = [], set()

    def walk(package, module, gates, path):
        for x in of.get(package, []):
            if not x.path or x.alias == "_" or (module and x.prefix[: len(module)] != module):
                continue
            here = (*path, (x.pos, x.leaf_no))
            if x.prefix:
                out.extend([(here, None, None, None, (), f"{x.lib} (module-scoped re-export)")] if x.target else [])
            elif x.target is None:
                out.extend([(here, None, None, None, (), f"{x.lib} (external crate)")] if x.external else [])
            elif not x.is_measured:
                out.append((here, None, None, None, (), f"{x.target}@{x.vers} (not measured)"))
            else:
                held = gates | set(x.gates)
                out.append((here, x.target, x.module, x.alias, tuple(sorted(held)), None))
                if x.is_module and (x.target, x.module) not in entered:
                    entered.add((x.target, x.module))
                    walk(x.target, x.module.split("::") if x.module else [], held, here)

    walk(port_package, [], frozenset(), ())
    return out


@pytest.mark.parametrize("seed", range(2))
def test_walks_on_random_graphs(spark, seed):
    """Both walks equal a recursion, in what they visit and in its order, over ports with cycles, gates, modules and dead ends."""
    rng = random.Random(seed)
    packages, ports, names = {}, {}, {}
    for n in range(6):
        yards = [f"w{n}y{i}" for i in range(6)]
        ports[f"f{n}"], names[f"f{n}"] = f"w{n}port", {y: y for y in [*yards, f"w{n}port", f"w{n}gone"]}
        for p in [f"w{n}port", *yards]:
            packages[p] = [(f"fn:m{rng.randrange(3)}::f{i}", "d") for i in range(2)] + [("fn:top", "d")]
            for i in range(rng.randint(4, 7)):
                gate = f'# [cfg (feature = "{rng.choice("abc")}")] ' if rng.random() < 0.4 else ""
                scope = f"m{rng.randrange(2)}::" if rng.random() < 0.15 else ""
                to = rng.choice([*yards, *yards, *yards, f"w{n}port", f"w{n}gone", "serde", "local"])
                what = rng.choice(["*", "*", "*", "*", "*", "m0", "m1 :: *", "top", "top as _", "{ m2 as other , * }"])
                packages[p].append((f"use:{scope}{gate}pub use {to} :: {what} ;" if scope else f"use:{gate}pub use {to} :: {what} ;", str(i)))
    w = World(spark, packages, ports, names, normal=[(p, "serde") for p in packages])
    leaves = w.leaves.collect()
    rounds = reexports.visits_in_rounds(w.leaves, w.facades).collect()
    walked = reexports.visits(w.leaves, w.facades).collect()
    total = 0
    for f, package in ports.items():
        want = plain_walk([x for x in leaves if x.facade_id == f], package)
        tell = lambda rows: [(r.target, r.module, r.alias, tuple(r.gates), r.unresolved) for r in sorted(rows, key=lambda r: r.visit_ord) if r.facade_id == f]  # noqa: B023, E731
        assert tell(rounds) == tell(walked) == [x[1:] for x in want]
        assert sorted([tuple(tuple(p) for p in r.visit_ord) for r in rounds if r.facade_id == f]) == [x[0] for x in want]
        total += len(want)
    assert total > 60
    assert {tuple(r) for r in reexports.facade_surface(w.items, w.facades, reexports.visited(w.leaves, w.facades, most=1)).select("facade_id", "key", "digest", F.array_join("cfg", "|")).collect()} == {
        tuple(r) for r in w.composed.select("facade_id", "key", "digest", F.array_join("cfg", "|")).collect()
    }


def test_streamed_hashes_equal_the_aggregate(spark):
    rng = random.Random(9)
    rows = [(f"p{rng.randrange(4)}", f"{rng.randrange(3)}", rng.choice([None, "fn:a", "fn:b", "é", f"k{i}"]), rng.choice([None, "", "d"]), rng.choice([None, [], ["x"], ["x", "y"]])) for i in range(800)]
    df = spark.createDataFrame(rows, "package string, vers string, key string, digest string, cfg array<string>").repartition(7)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = {tuple(r) for r in hashing.surface_hashes(df, ["package", "vers"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = df.groupBy("package", "vers").agg(F.count("*"), surface_hash(F.col("key"), F.col("digest"), F.col("cfg")))
    assert got == {tuple(r) for r in want.collect()} and len(got) == 12
    assert hashing.surface_hashes(df.where("false"), ["package", "vers"]).count() == 0


def test_a_release_of_a_million_items_is_streamed(spark):
    df = spark.range(1_000_000).select(F.lit("p").alias("package"), F.lit("1").alias("vers"), F.concat(F.lit("fn:"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("key"), F.lit("d").alias("digest"), F.array().cast("array<string>").alias("cfg"))
    want = hashlib.sha256("\0".join(f"fn:{i:08d}\0d\0" for i in range(1_000_000)).encode()).hexdigest()
    assert [tuple(r) for r in hashing.surface_hashes(df.repartition(5), ["package", "vers"]).collect()] == [("p", "1", 1_000_000, want)]
