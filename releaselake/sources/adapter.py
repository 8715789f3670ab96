"""The driver's tables seen as corpus tables: entities, releases, a prior index, dependencies, surface items and re-export lines.

The same SQL runs on Spark and on DuckDB. ``{name}`` stands for another view or table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("supplier", "lineitem", "documents", "orders", "events")
VIEWS = {
    "entities": """SELECT s_suppkey AS ord, concat('prov-', s_suppkey) AS id, concat('pkg-', s_suppkey) AS package, concat('pkg_', s_suppkey) AS lib_name,
       CASE s_suppkey % 5 WHEN 1 THEN 'dependency' WHEN 2 THEN 'dependency' WHEN 4 THEN 'companion' ELSE 'fork' END AS role,
       CASE s_suppkey % 5 WHEN 1 THEN concat('prov-', s_suppkey - 1) WHEN 2 THEN concat('prov-', s_suppkey - 2) WHEN 4 THEN concat('prov-', s_suppkey - 1) END AS served_id,
       s_suppkey % 5 = 0 AS is_facade
FROM {supplier}""",
    "li": """SELECT l_suppkey AS k, concat('pkg-', l_suppkey) AS package, concat('prov-', l_suppkey) AS provider_id,
       concat(year(l_shipdate) - 1991, '.', quarter(l_shipdate), '.0',
              CASE WHEN l_suppkey % 5 = 3 AND quarter(l_shipdate) = 4 THEN '-pre' ELSE '' END) AS vers,
       year(l_shipdate) AS yr, l_shipdate, l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus,
       CAST(l_quantity AS INT) AS qty
FROM {lineitem}""",
    "releases": """SELECT provider_id, package, vers, k, max(l_shipdate) AS created_at, count(*) AS n_rows,
       sum(l_linenumber) % 11 = 0 AS yanked, md5(concat(package, '@', vers)) AS cksum,
       CASE (k + max(yr)) % 5 WHEN 1 THEN '1.85' WHEN 2 THEN '1.97.1' WHEN 3 THEN '' WHEN 4 THEN '1.99' END AS rust_version
FROM {li} GROUP BY provider_id, package, vers, k""",
    "prior": """SELECT provider_id, vers, CASE WHEN k % 10 = 3 THEN md5(concat(package, '!', vers)) ELSE cksum END AS cksum,
       CASE WHEN k % 10 = 7 THEN NULL ELSE concat('sources/crates-io/', package, '/', vers, '.tar.gz') END AS blob
FROM {releases} WHERE created_at < TIMESTAMP '2001-01-01 00:00:00'""",
    "deps": """SELECT package, vers, CASE WHEN l_linenumber = 1 THEN concat('ext_', l_partkey % 13) ELSE concat('dep_', l_partkey % 167) END AS name,
       concat('^', l_linenumber) AS req, CASE l_returnflag WHEN 'R' THEN 'dev' ELSE 'normal' END AS kind, l_linestatus = 'F' AS optional
FROM {li}""",
    "own_items": """SELECT package, vers, k,
       concat(CASE l_linenumber % 4 WHEN 0 THEN 'fn' WHEN 1 THEN 'struct' WHEN 2 THEN 'enum' ELSE 'trait' END, ':',
              CASE WHEN l_partkey % 3 = 0 THEN '' ELSE concat('m', l_partkey % 5, '::') END, 'I', l_partkey % 200) AS key,
       substr(md5(concat(l_partkey, '|', qty)), 1, 10) AS digest,
       CASE WHEN l_linestatus = 'F' THEN 'cfg (feature = "x")' ELSE '' END AS cfg1,
       l_orderkey, l_linenumber, l_partkey
FROM {li}""",
    "use_items": """SELECT r.package, r.vers, r.k, l.line_no,
       CASE WHEN l.m = 1 THEN concat('use:# [cfg (feature = "platform")] pub use pkg_', r.k + 1, ' :: {{ m2 , m3 as renamed }} ;')
            WHEN l.line_no = 1 THEN concat('use:pub use pkg_', r.k + 1, ' :: * ;') WHEN l.line_no = 2 THEN concat('use:pub use pkg_', r.k + 2, ' :: m1 ;')
            ELSE 'use:pub use ext_3 :: Foo ;' END AS key
FROM {releases} r JOIN (SELECT 0 AS m, 1 AS line_no UNION ALL SELECT 0, 2 UNION ALL SELECT 0, 3 UNION ALL SELECT 1, 1) l ON l.m = r.k % 5""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view, or a table of the driver."""
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{n: view(spark, sf_dir, n) for n in inputs(name)})


def over(spark: SparkSession, name: str, **tables: DataFrame) -> DataFrame:
    """A view of the given tables instead of those that it names."""
    return spark.sql(VIEWS[name], **tables)


def inputs(name: str) -> list[str]:
    return sorted(set(re.findall(r"(?<!\{)\{(\w+)\}", VIEWS.get(name, ""))))


def with_views(sql: str) -> str:
    """A SQL text whose ``{name}`` are views, for an engine that has the tables: the views it needs go before it."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for n in inputs(name):
            need(n)
        if name in VIEWS and name not in ordered:
            ordered.append(name)

    named = sorted(set(re.findall(r"(?<!\{)\{(\w+)\}", sql)))
    for n in named:
        need(n)
    same = {n: n for n in [*VIEWS, *TABLES]}
    before = ",\n".join(f"{n} AS ({VIEWS[n].format(**same)})" for n in ordered)
    body = sql.format(**same).strip()
    if not before:
        return body
    return f"WITH {before},\n{body[5:]}" if body[:5].upper() == "WITH " else f"WITH {before}\n{body}"
