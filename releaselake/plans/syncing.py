"""Index sync and dataset queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import dataset, files, index, validate
from ..sources import published, writers
from ..sources.buckets import bucketed
from ..sources.shared import materialize, shared_path
from .registry import View, query


def _entities(v: View) -> DataFrame:
    return v("entities")


def _releases(v: View) -> DataFrame:
    """Adapter releases as index rows: of a registry index, named by their version."""
    return v("releases").withColumn("kind", F.lit("registry-index")).withColumn("id", F.col("vers"))


def _prior(v: View) -> DataFrame:
    return v("prior").select("provider_id", F.lit("registry-index").alias("kind"), F.col("vers").alias("id"), "cksum", "blob")


@query("""
SELECT r.provider_id, r.package, e.lib_name, 'registry' AS kind, r.vers, r.yanked, r.cksum, r.rust_version, CAST(NULL AS VARCHAR) AS api_hash
FROM {releases} r JOIN {entities} e ON e.id = r.provider_id WHERE e.role = 'fork'
""")
def dataset_versions(v: View) -> DataFrame:
    rows = dataset.contract_versions(_entities(v), _releases(v))
    return rows.select("provider_id", "package", "lib_name", "kind", "vers", "yanked", "cksum", "rust_version", "api_hash")


@query("SELECT id, role, concat(id, ' (', role, ')') AS label FROM {entities} WHERE role <> 'fork'")
def skipped_entities(v: View) -> DataFrame:
    return dataset.skipped(_entities(v))


@query("""
SELECT strftime(max(created_at), '%Y-%m-%dT%H:%M:%S') || '+00:00' AS synced_at FROM {releases}
""")
def coverage_stamp(v: View) -> DataFrame:
    """Stamps with fractions; those of even packages end in Z."""
    zone = F.when(F.col("k") % 2 == 0, "Z").otherwise("+00:00")
    stamped = v("releases").select(F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS"), zone).alias("created_at"))
    return dataset.coverage_stamp(stamped)


PLAN_SQL = """
SELECT r.provider_id, r.vers, CASE WHEN p.vers IS NOT NULL AND p.cksum IS NOT DISTINCT FROM r.cksum AND p.blob IS NOT NULL {keep} THEN '{yes}' ELSE '{no}' END AS status,
       CASE WHEN p.vers IS NOT NULL AND p.cksum IS NOT DISTINCT FROM r.cksum AND p.blob IS NOT NULL {keep} THEN p.blob END AS blob
FROM {{releases}} r LEFT JOIN {{prior}} p ON p.provider_id = r.provider_id AND p.vers = r.vers
"""


def _plan(df: DataFrame) -> DataFrame:
    return df.select("provider_id", "vers", "status", "blob")


@query(PLAN_SQL.format(keep="", yes="reused", no="new"))
def sync_plan(v: View) -> DataFrame:
    return _plan(index.classify(_releases(v), _prior(v)))


@query(PLAN_SQL.format(keep="", yes="reuse", no="would fetch"))
def sync_dry_run(v: View) -> DataFrame:
    return _plan(index.classify(_releases(v), _prior(v), dry_run=True))


@query(PLAN_SQL.format(keep="AND NOT (r.n_rows % 5 = 0)", yes="reused", no="new"))
def sync_forced(v: View) -> DataFrame:
    """Releases with a number of rows divisible by five are forced by their specs."""
    specs = v("releases").where("n_rows % 5 = 0").select(F.concat_ws("@", "package", "vers").alias("spec"))
    return _plan(index.classify(_releases(v), _prior(v), forced=index.forced_releases(specs)))


@query("""
WITH s AS (""" + PLAN_SQL.format(keep="", yes="reused", no="new") + """)
SELECT coalesce(provider_id, '(all)') AS provider_id, count(*) AS releases, count(*) FILTER (status = 'new') AS new, count(*) FILTER (status = 'reused') AS reused
FROM s GROUP BY ROLLUP (provider_id)
""")
def provider_counts(v: View) -> DataFrame:
    counts = index.sync_counts(index.classify(_releases(v), _prior(v)))
    return counts.withColumn("provider_id", F.coalesce("provider_id", F.lit("(all)")))


@query("""
SELECT count(*) AS versions, count(DISTINCT r.provider_id) AS providers FROM {releases} r JOIN {entities} e ON e.id = r.provider_id WHERE e.role = 'fork'
""")
def dataset_counts(v: View) -> DataFrame:
    return dataset.dataset_counts(dataset.contract_versions(_entities(v), _releases(v)))


@query("SELECT provider_id, vers, cksum FROM {releases} WHERE NOT (k % 7 = 0 AND yanked)")
def excluded_releases(v: View) -> DataFrame:
    """Every seventh provider excludes its yanked versions."""
    excluded = v("releases").where("k % 7 = 0 AND yanked").select("provider_id", "vers")
    return index.drop_excluded(v("releases"), excluded).select("provider_id", "vers", "cksum")


@query("""
SELECT r.package, r.vers, r.yanked, nullif(r.rust_version, '') AS rust_version,
       (SELECT coalesce(string_agg(DISTINCT d.name, ',' ORDER BY d.name), '') FROM {deps} d WHERE d.package = r.package AND d.vers = r.vers AND d.optional) AS feature_names,
       (SELECT count(*) FROM {deps} d WHERE d.package = r.package AND d.vers = r.vers) AS n_deps,
       (SELECT count(*) FROM {deps} d WHERE d.package = r.package AND d.vers = r.vers AND d.kind = 'normal') AS n_normal
FROM {releases} r
""")
def registry_meta(v: View) -> DataFrame:
    """Registry rows rebuilt from the views: optional dependencies are features, unspecified flags are left out."""
    dep = F.struct("name", "req", "optional", F.lit(None).cast("boolean").alias("default_features"), F.when(F.col("kind") != "normal", F.col("kind")).alias("kind"))
    d = v("deps").groupBy("package", "vers").agg(F.collect_list(dep).alias("deps"), F.collect_set(F.when(F.col("optional"), F.col("name"))).alias("f"))
    features = F.map_from_entries(F.transform("f", lambda n: F.struct(n, F.array(n))))
    rows = v("releases").select("package", "vers", "cksum", F.when(F.col("yanked"), True).alias("yanked")).join(d, ["package", "vers"], "left").withColumn("features", features)
    api = v("releases").select("package", F.col("vers").alias("num"), "rust_version", F.col("created_at").cast("string").alias("created_at"))
    meta = index.registry_meta(rows, api)
    return meta.select(
        "package", "vers", "yanked", "rust_version", F.array_join("feature_names", ",").alias("feature_names"), F.size("deps").cast("long").alias("n_deps"),
        F.size(F.filter("deps", lambda x: (x["kind"] == "normal") & x["default_features"])).cast("long").alias("n_normal"),
    )


def _config(v: View) -> DataFrame:
    """Every third provider declares no library name, every fourth no role beyond fork; repositories are known to the config for even ones."""
    e = v("entities")
    return e.select(
        "ord", "id", "package", F.when(e["ord"] % 3 == 0, F.lit("")).otherwise(F.col("lib_name")).alias("lib_name"), F.when(F.col("role") != "fork", F.col("role")).alias("role"), "served_id",
        F.when(e["ord"] % 2 == 0, F.concat(F.lit("https://git.example/"), "package")).alias("repository"), F.lit(None).cast("string").alias("note"),
    )


@query("""
SELECT ord, id, package, lib_name, role, served_id, CASE WHEN ord % 5 = 0 THEN concat('https://api.example/', package) WHEN ord % 2 = 0 THEN concat('https://git.example/', package) END AS repository,
       CASE WHEN ord % 4 = 0 THEN concat('about ', package) END AS description,
       CASE length(package) WHEN 3 THEN concat('3/', substr(package, 1, 1), '/', package) ELSE concat(substr(package, 1, 2), '/', substr(package, 3, 2), '/', package) END AS index_path
FROM {entities}
""")
def provider_record(v: View) -> DataFrame:
    """The API knows a repository of every fifth provider and a description of every fourth; an empty value comes last and does not count."""
    e = v("entities")
    one = e.select("package", F.lit(0).alias("ord"), F.when(e["ord"] % 5 == 0, F.concat(F.lit("https://api.example/"), "package")).alias("repository"), F.when(e["ord"] % 4 == 0, F.concat(F.lit("about "), "package")).alias("description"))
    api = one.union(one.select("package", F.lit(1), F.lit(""), F.lit(None).cast("string")))
    return index.provider_record(_config(v), api).drop("note")


@query("""
SELECT e.ord, e.id, e.package, e.lib_name, e.role, e.served_id, coalesce(CASE WHEN e.ord % 5 = 0 THEN concat('https://old.example/', e.package) END, CASE WHEN e.ord % 2 = 0 THEN concat('https://git.example/', e.package) END) AS repository,
       concat('was ', e.package) AS description, count(p.vers) AS releases
FROM {entities} e JOIN {prior} p ON p.provider_id = e.id WHERE e.ord % 4 <> 1 GROUP BY e.ord, e.id, e.package, e.lib_name, e.role, e.served_id
""")
def carry_forward(v: View) -> DataFrame:
    """A run over every fourth provider carries the others that the prior index has, with their releases as they are."""
    prior = v("prior")
    e = v("entities")
    before = e.join(prior.select(F.col("provider_id").alias("id")).distinct(), "id", "left_semi").select("id", F.when(e["ord"] % 5 == 0, F.concat(F.lit("https://old.example/"), "package")).alias("repository"), F.concat(F.lit("was "), "package").alias("description"))
    carried = index.carry_forward(_config(v), before, e.where("ord % 4 = 1").select("id")).drop("note")
    releases = prior.groupBy(F.col("provider_id").alias("id")).agg(F.count("*").alias("releases"))
    return carried.join(releases, "id")


@query("SELECT concat('prov-', s_suppkey + 3) AS id FROM {supplier} WHERE s_suppkey % 2 = 0 AND s_suppkey + 3 NOT IN (SELECT s_suppkey FROM {supplier})")
def unknown_selection(v: View) -> DataFrame:
    selected = v("entities").where("ord % 2 = 0").select(F.concat(F.lit("prov-"), F.col("ord") + 3).alias("id"))
    return index.unknown_providers(selected, v("entities"))


@query("""
WITH x AS (SELECT *, CASE WHEN ord % 10 = 4 THEN 'wat' ELSE role END AS r2, CASE WHEN ord % 10 = 9 THEN 'prov-ghost' ELSE served_id END AS f2, CASE WHEN ord % 10 = 0 THEN concat('prov-', ord + 2) WHEN ord % 5 = 0 THEN concat('prov-', ord + 3) END AS s2 FROM {entities})
SELECT id AS provider_id, 2 AS check_no, 'unknown role wat' AS message FROM x WHERE r2 = 'wat'
UNION ALL SELECT id, 3, concat('serves unknown provider ', f2) FROM x WHERE f2 IS NOT NULL AND f2 NOT IN (SELECT id FROM x)
UNION ALL SELECT id, 4, 'missing package' FROM x WHERE ord % 20 = 3
UNION ALL SELECT id, 5, 'no sources declared' FROM x WHERE ord % 20 = 7
UNION ALL SELECT id, 7, 'unknown surface source kind scan' FROM x WHERE is_facade AND ord % 15 = 0
UNION ALL SELECT id, 11, concat('surface source names unknown provider ', s2) FROM x WHERE is_facade AND s2 NOT IN (SELECT id FROM x)
UNION ALL SELECT a.id, 12, concat('surface source must be a dependency: ', a.s2) FROM x a JOIN x b ON b.id = a.s2 WHERE a.is_facade AND b.r2 <> 'dependency'
UNION ALL SELECT a.id, 13, concat('surface source must serve this provider: ', a.s2) FROM x a JOIN x b ON b.id = a.s2 WHERE a.is_facade AND b.r2 = 'dependency' AND b.f2 IS DISTINCT FROM a.id
UNION ALL SELECT id, 14, 'no adapter for source kind mirror' FROM x WHERE ord % 13 = 5 AND ord % 20 <> 7
""")
def config_violations(v: View) -> DataFrame:
    """Entities with injected faults: roles, served ids, packages, sources and facade sources."""
    o = F.col("ord")
    source = F.when(o % 13 == 5, F.lit("mirror")).otherwise(F.lit("registry-index"))
    from_ = F.when(o % 10 == 0, F.concat(F.lit("prov-"), o + 2)).when(o % 5 == 0, F.concat(F.lit("prov-"), o + 3))
    bad = v("entities").select(
        "ord", "id", F.when(o % 20 == 3, F.lit("")).otherwise(F.col("package")).alias("package"), F.when(o % 10 == 4, F.lit("wat")).otherwise(F.col("role")).alias("role"),
        F.when(o % 10 == 9, F.lit("prov-ghost")).otherwise(F.col("served_id")).alias("served_id"), F.when(o % 20 != 7, F.array(F.struct(source.alias("kind")))).alias("sources"),
        F.array().cast("array<string>").alias("exclude"), F.when(F.col("is_facade"), F.when(o % 15 == 0, F.lit("scan")).otherwise(F.lit("reexports"))).alias("surface_kind"), F.when(F.col("is_facade"), F.array(from_)).alias("surface_from"),
    )
    return validate.violations(bad)


@query("""
SELECT id, role, served_id FROM {entities} WHERE role = 'fork' UNION ALL SELECT e.id, e.role, e.served_id FROM {entities} e JOIN {entities} f ON f.id = e.served_id WHERE e.role = 'dependency' AND f.is_facade
""")
def measured_entities(v: View) -> DataFrame:
    return dataset.measured_entities(_entities(v)).select("id", "role", "served_id")


@query("SELECT f.id AS facade_id, e.lib_name, e.package FROM {entities} e JOIN {entities} f ON f.id = e.served_id AND f.is_facade WHERE e.role = 'dependency'")
def facade_graph(v: View) -> DataFrame:
    return dataset.facade_graph(_entities(v))


@query("SELECT DISTINCT package, vers, name FROM {deps} WHERE kind = 'normal'")
def dependency_aliases(v: View) -> DataFrame:
    return dataset.dependency_aliases(v("deps"))


@query("""
SELECT provider_id, vers, rust_version, CASE WHEN regexp_full_match(trim(rust_version), '[0-9]+([.][0-9]+)?([.][0-9]+)?') THEN array_to_string(list_resize(string_split(trim(rust_version), '.'), 3, '0'), '.') END AS floor
FROM {releases} r JOIN {entities} e ON e.id = r.provider_id AND e.role = 'fork' WHERE rust_version <> ''
""")
def declared_floors(v: View) -> DataFrame:
    return dataset.declared_floors(_entities(v), v("releases")).select("provider_id", "vers", "rust_version", "floor")


@query("SELECT r.package, r.vers, r.cksum FROM {releases} r JOIN {entities} e ON e.id = r.provider_id AND e.role = 'fork'")
def release_digests(v: View) -> DataFrame:
    return dataset.release_digests(_entities(v), v("releases"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'missing' WHEN doc_id % 3 = 1 AND doc_id % 7 = 0 THEN 'mismatch' END AS reason, CASE WHEN doc_id % 11 = 0 OR (doc_id % 3 = 1 AND doc_id % 7 = 0) THEN 'failed' ELSE 'built' END AS state
FROM {documents}
""")
def verified_files(v: View) -> DataFrame:
    """Documents as release blobs: every eleventh has no file, some have a wrong checksum, a third of them none."""
    d = v("documents").select(F.col("doc_id"), F.col("doc_id").cast("string").alias("package"), F.lit("1.0.0").alias("vers"), F.col("text").alias("content"))
    wrong = (F.col("doc_id") % 3 == 1) & (F.col("doc_id") % 7 == 0)
    given = F.when(F.col("doc_id") % 3 == 0, F.lit("")).when(wrong, F.lit("deadbeef")).otherwise(F.sha2(F.col("content").cast("binary"), 256))
    releases = d.withColumn("cksum", given).drop("content")
    present = d.where("doc_id % 11 <> 0").select("package", "vers", "content")
    return files.verified(releases, present).select("doc_id", "reason", "state")


@query("""
SELECT concat('sources/registry-index/', doc_id, '/1.0.0.tar.gz') AS blob, sha256(text) AS sha256, 'tar.gz' AS format FROM {documents}
""")
def described_blobs(v: View) -> DataFrame:
    d = v("documents").select(F.col("doc_id").cast("string").alias("package"), F.lit("1.0.0").alias("vers"), F.col("text").cast("binary").alias("content"))
    return files.described(d, "registry-index").select("blob", "sha256", "format")


@query("""
WITH m AS (SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'p/Cargo.toml' WHEN 1 THEN concat('p/src/d', doc_id, '.rs') WHEN 2 THEN 'p/tests/it.rs' WHEN 3 THEN 'p/../../evil' WHEN 4 THEN 'p/build.rs' ELSE '/etc/x' END AS path FROM {documents})
SELECT doc_id, CASE WHEN doc_id % 6 IN (0, 1, 4) THEN substr(path, 3) END AS kept, doc_id % 6 IN (3, 5) AS unsafe FROM m
""")
def member_filter(v: View) -> DataFrame:
    """Documents as archive members, some of them unsafe."""
    o = F.col("doc_id") % 6
    path = F.when(o == 0, "p/Cargo.toml").when(o == 1, F.concat(F.lit("p/src/d"), F.col("doc_id"), F.lit(".rs"))).when(o == 2, "p/tests/it.rs").when(o == 3, "p/../../evil").when(o == 4, "p/build.rs").otherwise("/etc/x")
    m = v("documents").select("doc_id", path.alias("path"), F.lit(0o664).alias("mode"))
    kept = files.source_members(m).select("doc_id", F.col("path").alias("kept"))
    return m.join(kept, "doc_id", "left").select("doc_id", "kept", files.is_unsafe(F.col("path")).alias("unsafe"))


@query("""
SELECT provider_id, count(*) AS releases, string_agg(concat(vers, '=', coalesce(blob, '')), ',' ORDER BY vers) AS listed FROM {prior} GROUP BY provider_id
""")
def nested_index(v: View) -> DataFrame:
    """The prior index nested as it is written, and flattened to text again."""
    rows = v("prior").withColumn("kind", F.lit("registry-index")).withColumn("id", F.col("vers")).withColumn("yanked", F.lit(False)).withColumn("ord", F.col("vers"))
    n = index.nested(rows)
    r = F.flatten(F.transform("sources", lambda s: s["releases"]))
    text = F.transform(r, lambda x: F.concat(x["id"], F.lit("="), F.coalesce(x["artifact"]["blob"], F.lit(""))))
    return n.select("provider_id", F.size(r).cast("long").alias("releases"), F.array_join(text, ",").alias("listed"))


@query(PLAN_SQL.format(keep="", yes="reused", no="new"))
def bucketed_sync_plan(v: View) -> DataFrame:
    """The sync plan over releases and a prior index that are stored by their keys, so that their join moves neither."""
    buckets = int(v("entities").sparkSession.conf.get("spark.sql.shuffle.partitions"))
    releases, prior = (bucketed(df, index.RELEASE, buckets, name) for df, name in ((_releases(v), "releases"), (_prior(v), "prior")))
    return _plan(index.classify(releases, prior))


def _publications(v: View) -> tuple[str, list[DataFrame]]:
    """The prior index published twice: every tenth provider is new in the second, another tenth vanished, and the checksums of every third have moved. What each publication moved."""
    rows = v("prior").withColumns({"kind": F.lit("registry-index"), "id": F.col("vers"), "ord": F.col("vers")})
    k = F.regexp_replace("provider_id", "prov-", "").cast("int")
    first, second = rows.where(k % 10 != 9), rows.where(k % 10 != 7).withColumn("cksum", F.when(k % 3 == 0, F.md5("cksum")).otherwise(F.col("cksum")))
    path = shared_path(rows.sparkSession, "published")
    return path, [published.publish(materialize(writers.index_lines(r), "lines"), path) for r in (first, second)]


@query("""
WITH p AS (SELECT DISTINCT provider_id AS id, CAST(substr(provider_id, 6) AS INT) AS k FROM {prior})
SELECT id, CASE WHEN k % 10 = 9 THEN 'new' WHEN k % 10 = 7 THEN 'vanished' ELSE 'changed' END AS change FROM p WHERE k % 10 IN (7, 9) OR k % 3 = 0
""")
def index_changes(v: View) -> DataFrame:
    """The providers that a second publication moved, as the hash trees tell."""
    return _publications(v)[1][1]


@query("""
SELECT provider_id AS id, CASE WHEN k % 10 = 9 OR k % 3 = 0 THEN 2 ELSE 1 END AS version, count(*) AS releases
FROM (SELECT provider_id, CAST(substr(provider_id, 6) AS INT) AS k FROM {prior}) WHERE k % 10 <> 7 GROUP BY provider_id, k
""")
def published_index(v: View) -> DataFrame:
    """What is published after that, and the version that wrote each provider last."""
    path, _ = _publications(v)
    text = F.get_json_object("json", "$.providers[0].sources[0].releases[*].id")
    return published.published(v("entities").sparkSession, path).select("id", "version", F.size(F.split(text, ",")).cast("long").alias("releases"))
