import datetime
import os

import duckdb
import pytest

from releaselake.plans import ORACLES, QUERIES

LINE = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string, l_shipdate timestamp"


@pytest.fixture(scope="module")
def lines(spark, tmp_path_factory):
    """Packages 5 (a facade) and 3 and 8 (plain forks), three releases each; order 1 locks all three, order 2 the facade alone."""
    at = str(tmp_path_factory.mktemp("plans"))
    rows = []
    for k in (5, 3, 8):
        for year, quarter in ((1997, 1), (1997, 2), (1997, 4)):
            for part in (1, 2, 3):
                order = 2 if (k, quarter, part) == (5, 2, 3) else 1 if part == 1 else 8
                rows.append((order, part, k, part, float(quarter if part == 2 else 1), "N", "O", datetime.datetime(year, quarter * 3 - 1, 10)))
    spark.createDataFrame(rows, LINE).coalesce(1).write.parquet(f"{at}/lineitem.parquet")
    spark.createDataFrame([(k,) for k in (3, 5, 8)], "s_suppkey long").coalesce(1).write.parquet(f"{at}/supplier.parquet")
    return at


def both(spark, at, name):
    """The query's rows, which equal its SQL's."""
    db = duckdb.connect()
    for t in ("lineitem", "supplier"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(at, t)}.parquet/*.parquet')")
    df = QUERIES[name](spark, at)
    got = [tuple(r) for r in df.collect()]
    want = db.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    return [dict(zip(df.columns, r)) for r in got]


def test_plans_cover_every_release_step_of_every_fork(spark, lines):
    got = both(spark, lines, "fork_migration_plans")
    assert {(r["package"], r["vers"]) for r in got} == {(f"pkg-{k}", v) for k in (3, 5, 8) for v in ("6.1.0", "6.2.0")}
    assert len(got) == 3 * 2 * 3
    assert {r["action"] for r in got} == {"keep", "manual"}
    assert {r["id"] for r in both(spark, lines, "fork_rule_check")} == {f"prov-{k}@{v}" for k in (3, 5, 8) for v in ("6.1.0", "6.2.0")}


def test_plan_applies_a_rule_only_to_its_own_release(spark):
    from releaselake.operators import analyze

    by = "package string, vers string, "
    old = spark.createDataFrame([(p, v, "a", "1") for p in ("p", "q") for v in ("1", "2")], by + "key string, digest string")
    new = spark.createDataFrame([("p", "1", "a", "1"), ("p", "2", "b", "1")], by + "key string, digest string")
    rules = spark.createDataFrame([("p", "2", "a", "b", "applies"), ("q", "1", "a", "c", "gated")], by + "from_key string, to_key string, status string")
    got = {tuple(r) for r in analyze.migration_plan(old, old, new, rules, ("package", "vers")).collect()}
    assert got == {("p", "1", "a", "keep", None), ("p", "2", "a", "rewrite", "b"), ("q", "1", "a", "manual", None), ("q", "2", "a", "manual", None)}


def test_audit_judges_facade_forks(spark, lines):
    got = {r["workspace"]: r for r in both(spark, lines, "fork_workspace_audit")}
    assert set(got) == {"ws-1", "ws-2", "ws-8"} and [got[w]["refused"] for w in sorted(got)] == [True, False, True]
    assert sum(got["ws-1"][c] for c in ("matches", "same_generation", "clashes", "unverifiable")) == 9 and got["ws-2"]["matches"] == 1


def test_used_symbols_are_whole_keys_and_digests_of_all_forks(spark, lines):
    got = {(r["package"], r["vers"]): r for r in both(spark, lines, "fork_used_api_report")}
    assert {p for p, _ in got} == {"pkg-3", "pkg-5", "pkg-8"} and got["pkg-3", "6.1.0"]["checkable"] == 2
    assert [got["pkg-3", v]["compatible"] for v in ("6.1.0", "6.2.0", "6.4.0-pre")] == [True, False, False]
    assert [(r["package"], r["first"], r["last"], r["releases"]) for r in both(spark, lines, "fork_compat_window") if r["package"] == "pkg-3"] == [("pkg-3", "6.1.0", "6.1.0", 1)]


def test_whole_surfaces_in_classes_and_trait_breaks(spark, lines):
    classes = both(spark, lines, "full_generation_classes")
    assert sorted((r["members"], r["packages"], r["twins"]) for r in classes) == [(3, 3, True)] * 3
    assert both(spark, lines, "full_trait_breaks") == []
