"""Readers, writers and blobs: tables are written in the formats of the corpus to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.versions import compiler_version, semver_key
from ..operators import attest, curation, dataset, files, index
from ..sources import adapters, readers, writers
from ..sources.shared import materialize, shared_path
from .registry import View, query


def _write_lines(rows: DataFrame, name: str, by: str | None = None) -> str:
    """``rows`` with a column json as lines; a folder with one file for each value of ``by`` if given, lines in order of ``at``."""
    path = shared_path(rows.sparkSession, name)
    if by:
        rows.repartition(by).sortWithinPartitions(by, "at").select("json", by).write.partitionBy(by).text(path)
    else:
        rows.select("json").write.text(path)
    return path


def _object(**columns: F.Column) -> F.Column:
    return F.to_json(F.struct(*(c.alias(k) for k, c in columns.items()))).alias("json")


@query("""
SELECT r.package, r.vers, r.cksum, r.yanked, 2 * (row_number() OVER (PARTITION BY r.package ORDER BY r.vers) - 1) AS ord, coalesce(d.n, 0) AS n_deps, coalesce(d.o, 0) AS n_optional
FROM {releases} r LEFT JOIN (SELECT package, vers, count(*) AS n, count(*) FILTER (optional) AS o FROM {deps} GROUP BY package, vers) d ON d.package = r.package AND d.vers = r.vers
""")
def registry_rows_read(v: View) -> DataFrame:
    """Registry rows as lines of one file a package, each followed by a blank line."""
    dep = F.struct("name", "req", F.when(F.col("optional"), True).alias("optional"), "kind")
    deps = v("deps").groupBy("package", "vers").agg(F.collect_list(dep).alias("deps"))
    r = v("releases").join(deps, ["package", "vers"], "left").select("package", F.col("vers").alias("at"), _object(vers=F.col("vers"), cksum=F.col("cksum"), yanked=F.col("yanked"), deps=F.col("deps")))
    rows = readers.registry_rows(r.sparkSession, _write_lines(r.withColumn("json", F.concat("json", F.lit("\n"))), "registry-rows", "package"))
    n = F.coalesce(F.size("deps"), F.lit(0))
    optional = F.coalesce(F.size(F.filter("deps", lambda d: F.coalesce(d["optional"], F.lit(False)))), F.lit(0))
    return rows.select("package", "vers", "cksum", "yanked", F.col("ord").cast("long").alias("ord"), n.cast("long").alias("n_deps"), optional.cast("long").alias("n_optional"))


@query("""
SELECT package, vers AS num, CASE WHEN k % 3 = 0 THEN '9.9' ELSE rust_version END AS rust_version, strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at, concat('https://git.example/', package) AS repository FROM {releases}
""")
def api_metadata_read(v: View) -> DataFrame:
    """API metadata, one document a package; every third package lists its versions twice, and the last of them counts."""
    r = v("releases").withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss"))
    one = F.struct(F.col("vers").alias("num"), "rust_version", "created_at")
    more = F.struct(F.col("vers").alias("num"), F.lit("9.9").alias("rust_version"), "created_at")
    docs = r.groupBy("package").agg(F.collect_list(one).alias("a"), F.collect_list(F.when(F.col("k") % 3 == 0, more)).alias("b"))
    crate = F.struct(F.concat(F.lit("https://git.example/"), "package").alias("repository"))
    path = _write_lines(docs.select("package", F.lit(0).alias("at"), _object(crate=crate, versions=F.concat("a", "b"))), "api", "package")
    spark = r.sparkSession
    return readers.api_versions(spark, path).join(readers.api_packages(spark, path).select("package", "repository"), "package").select("package", "num", "rust_version", "created_at", "repository")


@query("""
SELECT e.id AS provider_id, e.package, concat('https://git.example/', e.package) AS repository, p.vers AS id, p.cksum, p.blob, coalesce(r.yanked, FALSE) AS yanked, r.rust_version,
       row_number() OVER (PARTITION BY e.id ORDER BY p.vers) - 1 AS ord
FROM {entities} e JOIN {prior} p ON p.provider_id = e.id JOIN {releases} r ON r.provider_id = p.provider_id AND r.vers = p.vers
""")
def index_round_trip(v: View) -> DataFrame:
    """The prior index, of which even providers were synced now and odd ones carried forward, written nested and read flat."""
    e = v("entities").select("ord", "id", "package", F.concat(F.lit("https://git.example/"), "package").alias("repository"), F.concat(F.lit("was "), "id").alias("description"))
    merged = index.merged_index(e.where("ord % 2 = 0"), e.where("ord % 2 = 1").drop("description"))
    meta = v("releases").select("provider_id", "vers", "yanked", "rust_version")
    rows = v("prior").join(meta, ["provider_id", "vers"]).withColumns({"kind": F.lit("registry-index"), "id": F.col("vers"), "ord": F.col("vers"), "format": F.lit("tar.gz")})
    path = shared_path(rows.sparkSession, "index")
    writers.write_index(rows, path, merged)
    flat = readers.corpus_index(rows.sparkSession, path)
    known = readers.index_providers(rows.sparkSession, path).select(F.col("id").alias("provider_id"), "repository")
    return flat.join(known, "provider_id").select("provider_id", "package", "repository", "id", "cksum", "blob", "yanked", "rust_version", F.col("ord").cast("long").alias("ord"))


@query("SELECT r.provider_id, r.vers, r.cksum, r.rust_version FROM {releases} r JOIN {entities} e ON e.id = r.provider_id WHERE e.role = 'fork'")
def dataset_round_trip(v: View) -> DataFrame:
    """The contract dataset, written by ranges of providers and read again."""
    rows = v("releases").withColumn("kind", F.lit("registry-index"))
    path = shared_path(rows.sparkSession, "dataset")
    writers.write_dataset(dataset.contract_versions(v("entities"), rows), path)
    return rows.sparkSession.read.parquet(path).select("provider_id", "vers", "cksum", "rust_version")


@query("""
SELECT package, vers, row_number() OVER (PARTITION BY package, vers ORDER BY l_orderkey, l_linenumber, l_partkey) - 1 AS pos, key, CASE WHEN l_linenumber = 2 THEN '' ELSE digest END AS digest, cfg1 AS cfg FROM {own_items}
UNION ALL SELECT concat(package, '-empty'), vers, NULL, NULL, NULL, NULL FROM {releases}
""")
def surfaces_read(v: View) -> DataFrame:
    """Analysis rows, a document a release: an earlier row of every release is without effect, and another package has null surfaces, which are measured and empty."""
    gates = F.when(F.col("cfg1") != "", F.array("cfg1"))
    item = F.struct("l_orderkey", "l_linenumber", "l_partkey", F.struct("key", F.when(F.col("l_linenumber") != 2, F.col("digest")).alias("digest"), gates.alias("cfg")).alias("i"))
    full = v("own_items").groupBy("package", "vers").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: x["i"]).alias("surface"))
    old = F.struct("package", "vers", F.filter("surface", lambda x: F.lit(False)).alias("surface"))
    none = F.struct(F.concat("package", F.lit("-empty")).alias("package"), "vers", F.filter(F.lit(None).cast(full.schema["surface"].dataType), lambda x: F.lit(False)).alias("surface"))
    path = _write_lines(full.select(_object(rows=F.array(old, F.struct("package", "vers", "surface"), none))), "analysis")
    s = readers.analysis_surfaces(full.sparkSession, path, multi_line=False)
    items = readers.surface_items(s).select("package", "vers", F.col("pos").cast("long").alias("pos"), "key", "digest", F.array_join("cfg", "|").alias("cfg"))
    return items.unionByName(s.where("size(surface) = 0").select("package", "vers"), allowMissingColumns=True)


@query("""
SELECT id AS provider_id, concat(package, '-kit') AS companion, CASE WHEN ord % 2 = 0 THEN 'mirror' ELSE 'fixed' END AS pin_kind, CASE WHEN ord % 2 = 1 THEN '0.1.0' END AS pin_fixed FROM {entities} WHERE role = 'fork'
""")
def companions_read(v: View) -> DataFrame:
    """Curated companions of all forks, half of them mirrored and half fixed."""
    e = dataset.forks(v("entities"))
    pin = F.when(e["ord"] % 2 == 0, F.lit('"mirror"')).otherwise(F.lit('{"fixed":"0.1.0"}'))
    line = F.concat(F.lit('{"companions":{"'), "id", F.lit('":{"package":"'), "package", F.lit('-kit","pin":'), pin, F.lit("}}}"))
    path = _write_lines(e.select(line.alias("json")), "companions")
    return readers.companions(readers.curated(e.sparkSession, path, "companions", multi_line=False)).select("provider_id", F.col("package").alias("companion"), "pin_kind", "pin_fixed")


@query("""
SELECT concat('contract-', ord // 5) AS contract_id, row_number() OVER (PARTITION BY ord // 5 ORDER BY ord) - 1 AS ord, id, package, CASE WHEN ord % 2 = 1 THEN lib_name END AS lib_name,
       nullif(role, 'fork') AS role, served_id, is_facade, CASE WHEN is_facade THEN concat('prov-', ord + 1, ',prov-', ord + 2) END AS surface_from, CASE WHEN ord % 7 = 0 THEN '1.1.0,1.2.0' END AS exclude
FROM {entities}
""")
def provider_config_read(v: View) -> DataFrame:
    """A config for each facade and those around it, in which default roles and names are absent."""
    even, facade = F.col("ord") % 2 == 0, F.col("is_facade")
    layers = F.array(*(F.concat(F.lit("prov-"), F.col("ord") + i) for i in (1, 2)))
    provider = F.struct(
        "ord", "id", "package", F.when(~even, F.col("lib_name")).alias("lib_name"), F.nullif("role", F.lit("fork")).alias("role"), F.col("served_id").alias("for"),
        F.when(F.col("ord") % 7 == 0, F.array(F.lit("1.1.0"), F.lit("1.2.0"))).alias("exclude"), F.when(facade, F.struct(F.lit("reexports").alias("kind"), layers.alias("from"))).alias("surface_source"),
        F.array(F.struct(F.lit("registry-index").alias("kind"))).alias("sources"),
    )
    contracts = v("entities").groupBy(F.floor(F.col("ord") / 5).alias("n")).agg(F.array_sort(F.collect_list(provider)).alias("providers"))
    path = _write_lines(contracts.select(_object(contract=F.struct(F.concat(F.lit("contract-"), "n").alias("id")), providers=F.transform("providers", lambda p: p.dropFields("ord")))), "providers")
    p = readers.provider_config(contracts.sparkSession, path, multi_line=False)
    return p.select("contract_id", F.col("ord").cast("long").alias("ord"), "id", "package", "lib_name", "role", "served_id", "is_facade", F.array_join("surface_from", ",").alias("surface_from"), F.array_join("exclude", ",").alias("exclude"))


@query("""
WITH d AS (SELECT CASE WHEN r.k % 2 = 0 THEN 'tvm' ELSE 'eac' END AS kind, r.package, r.vers, r.k % 3 <> 0 AS tagged FROM {releases} r JOIN {entities} e ON e.id = r.provider_id WHERE e.role = 'fork')
SELECT kind, package, vers, sha256(concat('{{', CASE WHEN tagged THEN concat('"schema":"', kind, '.v1",') ELSE '' END, '"of":"', package, '@', vers, '"}}', chr(10))) AS sha256, CASE WHEN tagged THEN concat(kind, '.v1') END AS schema FROM d
""")
def attestation_docs_read(v: View) -> DataFrame:
    """A document a release of every fork, those of every third package without a schema tag: most lie in archives of many, those of every tenth fork in a folder of their own each."""
    r = v("releases").join(dataset.forks(v("entities")).select(F.col("id").alias("provider_id")), "provider_id", "left_semi")
    r = r.withColumn("kind", F.when(F.col("k") % 2 == 0, "tvm").otherwise("eac"))
    spark, alone = r.sparkSession, F.col("k") % 25 == 3
    fields = [F.when(F.col("k") % 3 != 0, F.concat("kind", F.lit(".v1"))).alias("schema"), F.concat_ws("@", "package", "vers").alias("of")]
    path, archive = shared_path(spark, "documents"), shared_path(spark, "archive")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a given number, since small rows in many files would else fall to one task
    r.where(alone).select("kind", "package", "vers", *fields).repartition(tasks, "package", "vers").write.partitionBy("kind", "package", "vers").json(path)
    r.where(~alone).select("kind", "package", "vers", F.concat(F.to_json(F.struct(*fields)), F.lit("\n")).alias("text")).write.json(archive)
    return readers.attestation_docs(spark, path).unionByName(readers.attestation_archive(spark, archive))


HERE = ("t1", "1.98.1", "1.98.1")


def _environment(v: View, rustc: str = HERE[1]) -> DataFrame:
    return v("entities").sparkSession.createDataFrame([(HERE[0], rustc, HERE[2])], "tool string, rustc string, rustdoc string")


def _entries(v: View) -> DataFrame:
    doc = lambda k: F.struct(F.md5(F.concat(F.lit(k), "cksum").cast("binary")).alias("sha256"), F.lit("v1").alias("schema")).alias(k)
    return v("releases").select("package", "vers", "cksum", F.md5("vers").alias("lock"), F.nullif("rust_version", F.lit("")).alias("floor"), doc("tvm"), F.when(F.col("k") % 2 == 0, doc("eac")).alias("eac"))


@query("""
SELECT package, vers, cksum, md5(vers) AS lock, nullif(rust_version, '') AS floor, md5(concat('tvm', cksum)) AS tvm, CASE WHEN k % 2 = 0 THEN md5(concat('eac', cksum)) END AS eac FROM {releases}
""")
def attestations_round_trip(v: View) -> DataFrame:
    """The attestation index, written and read; entries that are no objects are left out."""
    rows = _entries(v)
    path = shared_path(rows.sparkSession, "attestations")
    writers.write_attestations(rows, path, _environment(v))
    rows.select(F.concat(F.lit('{"schema":"attestations.v1","entries":{"'), "package", F.lit('/0.0.0":"lost"}}')).alias("json")).write.mode("append").text(path)
    return readers.attestation_index(rows.sparkSession, path).select("package", "vers", "cksum", "lock", "floor", F.col("tvm.sha256").alias("tvm"), F.col("eac.sha256").alias("eac"))


@query("SELECT package, vers, cksum, md5(concat('tvm', cksum)) AS tvm FROM {releases} WHERE k % 4 IN (0, 1)")
def environment_gate(v: View) -> DataFrame:
    """An index whose entries were recorded now for half of the packages, and for the others under another compiler or another schema: only the former are used."""
    rows = _entries(v).join(v("releases").select("package", "vers", "k"), ["package", "vers"])
    path, spark = shared_path(rows.sparkSession, "attestations"), rows.sparkSession
    kinds = (("k % 4 IN (0, 1)", HERE[1], "attestations.v1"), ("k % 4 = 2", "1.99.0", "attestations.v1"), ("k % 4 = 3", HERE[1], "v0"))
    for i, (which, rustc, schema) in enumerate(kinds):
        writers.write_attestations(rows.where(which).drop("k"), f"{path}/part={i}", _environment(v, rustc), schema)
    usable = attest.usable_entries(readers.attestation_index(spark, path), _environment(v), "attestations.v1")
    return usable.select("package", "vers", "cksum", F.col("tvm.sha256").alias("tvm"))


@query("""
SELECT package, vers, CASE WHEN k % 3 = 0 AND k % 4 = 0 THEN 'the recorded environment differs' ELSE concat(CASE WHEN k % 3 <> 0 THEN concat('tool changed (', substr(md5(package), 1, 12), ' → ', substr(md5(vers), 1, 12), ')') ELSE '' END,
       CASE WHEN k % 3 <> 0 AND k % 4 <> 0 THEN '; ' ELSE '' END, CASE WHEN k % 4 <> 0 THEN concat('rustc changed (', CASE WHEN k % 4 = 1 THEN 'unknown' ELSE '1.97.1' END, ' → 1.98.1)') ELSE '' END) END AS note
FROM {releases}
""")
def environment_notes(v: View) -> DataFrame:
    """A recorded environment for each release: the tool of two thirds moved, the compiler of three quarters, some of which is unknown."""
    k, here = F.col("k"), F.lit("1.98.1")
    was = F.struct(F.when(k % 3 != 0, F.md5("package")).otherwise(F.md5("vers")).alias("tool"), F.when(k % 4 == 0, here).when(k % 4 != 1, "1.97.1").alias("rustc"), here.alias("rustdoc"))
    now = F.struct(F.md5("vers").alias("tool"), here.alias("rustc"), here.alias("rustdoc"))
    return attest.environment_note(v("releases").select("package", "vers", was.alias("recorded"), now.alias("current"))).select("package", "vers", "note")


@query("SELECT package, vers, CASE WHEN k % 4 = 0 THEN NULL ELSE vers END AS found FROM {releases}")
def compiler_lines(v: View) -> DataFrame:
    """Version lines of a compiler: the version comes first, second, or too late."""
    k, at = F.col("k") % 4, F.concat("vers", F.lit(","))
    line = F.when(k == 0, F.concat(F.lit("some rustc "), "vers")).when(k == 1, F.concat(F.lit("rustc "), at, F.lit(" (abc 2026-01-01)"))).otherwise(F.concat("vers", F.lit(" rustc")))
    return v("releases").select("package", "vers", compiler_version(line).alias("found"))


@query("""
SELECT concat('{{"deps":[{{"kind":null,"name":"', package, '"}}],"features":{{"a":["', vers, '"],"b":[]}},"meta":{{"cksum":"', cksum, '","yanked":', CASE WHEN yanked THEN 'true' ELSE 'null' END, '}}}}') AS json FROM {releases}
""")
def canonical_rows(v: View) -> DataFrame:
    """Nested rows as canonical JSON: fields and map keys in order at every level, nulls written."""
    none = F.array().cast("array<string>")
    meta = F.struct(F.when(F.col("yanked"), True).alias("yanked"), "cksum").alias("meta")
    features = F.create_map(F.lit("b"), none, F.lit("a"), F.array("vers")).alias("features")
    return writers.canonical_json(v("releases").select(meta, features, F.array(F.struct(F.col("package").alias("name"), F.lit(None).cast("string").alias("kind"))).alias("deps")))


#: Documents as source files of blobs with about a hundred members each, dealt over ten packages.
MEMBER_SQL = """
mb AS (SELECT 1 + doc_id % 10 AS k, concat('pkg-', 1 + doc_id % 10) AS package, concat(doc_id // 1000, '.0.0') AS vers, doc_id, text FROM {documents}),
me AS (SELECT ord FROM {entities} WHERE role = 'fork' UNION ALL SELECT e.ord FROM {entities} e JOIN {entities} f ON f.id = e.served_id AND f.is_facade WHERE e.role = 'dependency')
"""


def _blobs(v: View) -> tuple[DataFrame, DataFrame]:
    """Releases with the path of their blob, and the blobs: sources, a manifest, and a file outside them. Every fourth release has no blob."""
    d = v("documents").select(F.concat(F.lit("pkg-"), 1 + F.col("doc_id") % 10).alias("package"), F.concat(F.floor(F.col("doc_id") / 1000), F.lit(".0.0")).alias("vers"), "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    source = d.select("package", "vers", F.concat(F.lit("top/src/d"), "doc_id", F.lit(".rs")).alias("path"), F.lit(0o640).alias("mode"), "content")
    keys = d.select("package", "vers").distinct()
    extra = lambda name, mode: keys.select("package", "vers", F.lit(name).alias("path"), F.lit(mode).alias("mode"), F.col("package").cast("binary").alias("content"))
    members = source.union(extra("top/Cargo.toml", 0o600)).union(extra("top/README.md", 0o644)).union(extra("top/build.rs", 0o755))
    blob = F.when(F.substring_index("vers", ".", 1).cast("int") % 4 != 3, F.concat_ws("/", F.lit("sources"), "package", "vers"))
    return keys.select(F.regexp_replace("package", "pkg-", "prov-").alias("provider_id"), "package", "vers", blob.alias("blob")), files.packed(members)


@query("WITH " + MEMBER_SQL + """,
ks AS (SELECT DISTINCT k, package, vers FROM mb)
SELECT package, vers, concat('src/d', doc_id, '.rs') AS path, 420 AS mode, sha256(coalesce(text, '')) AS sha256 FROM mb WHERE k IN (SELECT ord FROM me) AND CAST(split_part(vers, '.', 1) AS INT) % 4 <> 3
UNION ALL SELECT package, vers, 'Cargo.toml', 420, sha256(package) FROM ks WHERE k IN (SELECT ord FROM me) AND CAST(split_part(vers, '.', 1) AS INT) % 4 <> 3
UNION ALL SELECT package, vers, 'build.rs', 493, sha256(package) FROM ks WHERE k IN (SELECT ord FROM me) AND CAST(split_part(vers, '.', 1) AS INT) % 4 <> 3
""")
def extracted_members(v: View) -> DataFrame:
    """Source members of the blobs of measured entities."""
    releases, blobs = _blobs(v)
    members = files.source_members(files.extracted(dataset.measured_entities(v("entities")), releases, blobs))
    return members.select("package", "vers", "path", "mode", F.sha2("content", 256).alias("sha256"))


@query("WITH " + MEMBER_SQL + """,
w AS (SELECT * FROM mb WHERE k IN (SELECT ord FROM me) AND CAST(split_part(vers, '.', 1) AS INT) % 4 <> 3)
SELECT count(DISTINCT concat(package, '@', vers)) AS blobs, count(*) + 3 * count(DISTINCT concat(package, '@', vers)) AS members FROM w
""")
def extracted_blobs(v: View) -> DataFrame:
    """How many blobs and members an extraction of the measured entities wrote, as it counted them itself."""
    releases, blobs = _blobs(v)
    counts = Observation("extraction")
    members = files.extracted(dataset.measured_entities(v("entities")), releases, blobs, counts)
    members.write.parquet(shared_path(members.sparkSession, "extracted"))
    return members.sparkSession.createDataFrame([(counts.get["blobs"], counts.get["members"])], "blobs long, members long")


#: Small blobs of some ten documents each, a part of which no extraction may take.
HOSTILE_SQL = """
hb AS (SELECT DISTINCT concat('pkg-', 1 + doc_id % 10) AS package, concat(doc_id // 100, '.0.0') AS vers, (doc_id // 100) % 7 AS h FROM {documents})
"""


def _hostile(v: View) -> DataFrame:
    d = v("documents").select(F.concat(F.lit("pkg-"), 1 + F.col("doc_id") % 10).alias("package"), F.floor(F.col("doc_id") / 100).alias("n"), "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    d = d.withColumn("vers", F.concat("n", F.lit(".0.0")))
    source = d.select("package", "vers", F.concat(F.lit("top/src/d"), "doc_id", F.lit(".rs")).alias("path"), F.lit(0o640).alias("mode"), "content")
    h = F.col("n") % 7
    name = F.when(h == 1, "top/src/../../../etc/passwd").when(h == 2, "top/src/../../evil").when(h == 3, "/top/src/x.rs").when(h == 4, "top/src/a/../fine.rs")
    more = d.select("package", "vers", name.alias("path"), h.alias("h")).distinct()
    extra = more.where("path is not null").select("package", "vers", "path").union(more.where("h <> 5").select("package", "vers", F.lit("top/Cargo.toml")))
    return files.packed(source.union(extra.select("package", "vers", "path", F.lit(0o644).alias("mode"), F.col("package").cast("binary").alias("content"))))


@query("WITH " + HOSTILE_SQL + """
SELECT package, vers, CASE h WHEN 1 THEN 'unsafe path top/src/../../../etc/passwd' WHEN 2 THEN 'unsafe path top/src/../../evil' WHEN 3 THEN 'unsafe path /top/src/x.rs' ELSE 'no manifest' END AS reason FROM hb WHERE h IN (1, 2, 3, 5)
""")
def refused_blobs(v: View) -> DataFrame:
    """Blobs that an extraction refuses: members that lead out, absolute ones, and blobs without a manifest."""
    return files.refused(_hostile(v))


@query("WITH " + HOSTILE_SQL + """
SELECT d.package, d.vers, count(*) + 1 + max(CASE h WHEN 4 THEN 1 ELSE 0 END) AS members FROM (SELECT concat('pkg-', 1 + doc_id % 10) AS package, concat(doc_id // 100, '.0.0') AS vers FROM {documents}) d
JOIN hb ON hb.package = d.package AND hb.vers = d.vers WHERE h NOT IN (1, 2, 3, 5) GROUP BY d.package, d.vers
""")
def accepted_members(v: View) -> DataFrame:
    """The extraction of all others, with the refused blobs set apart; it would stop at any of those."""
    blobs = materialize(_hostile(v), "hostile")
    fine = blobs.join(files.refused(blobs), ["package", "vers"], "left_anti")
    releases = fine.select(F.col("package").alias("provider_id"), "package", "vers", F.lit("b").alias("blob"))
    members = files.extracted(releases.select(F.col("provider_id").alias("id")).distinct(), releases, fine)
    return files.source_members(members).groupBy("package", "vers").agg(F.count("*").alias("members"))


@query("SELECT provider_id, vers, CASE WHEN CAST(split_part(vers, '.', 1) AS INT) < 7 THEN 'early' ELSE 'later' END AS note FROM {releases} WHERE CAST(split_part(vers, '.', 1) AS INT) < 9")
def notes_read(v: View) -> DataFrame:
    """Curated notes of all providers, a document each, bounding their versions."""
    line = F.concat(F.lit('{"notes":[{"provider":"'), "id", F.lit('","below":"7.0.0","note":"early"},{"provider":"'), "id", F.lit('","below":"9.0.0","note":"later"}]}'))
    path = _write_lines(v("entities").select(line.alias("json")), "notes")
    notes = readers.curated(v("entities").sparkSession, path, "notes", multi_line=False).withColumnRenamed("provider", "provider_id")
    return curation.binding_notes(v("releases"), notes)


@query("""
SELECT row_number() OVER (ORDER BY id) - 1 AS n, id, (SELECT string_agg(p.vers, ',' ORDER BY p.vers) FROM {prior} p WHERE p.provider_id = e.id) AS releases
FROM {entities} e WHERE id IN (SELECT provider_id FROM {prior})
""")
def index_line_order(v: View) -> DataFrame:
    """The places that lines have in the files of a written index, and the releases within each, in the order in which they stand there."""
    rows = v("prior").withColumns({"kind": F.lit("registry-index"), "id": F.col("vers"), "ord": F.col("vers")})
    path, spark = shared_path(rows.sparkSession, "index"), rows.sparkSession
    writers.write_index(rows, path)
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\n")).alias("at", "line")).where("line <> ''")
    place = F.row_number().over(Window.orderBy("file", "at")) - 1  # one window over a line for each provider
    listed = F.from_json("line", readers.INDEX)["providers"][0]
    return lines.select(place.cast("long").alias("n"), listed["id"].alias("id"), F.array_join(listed["sources"][0]["releases"]["id"], ",").alias("releases"))


@query("""
SELECT concat('{{"cksum":"', r.cksum, '","kind":"registry","package":"', r.package, '","provider_id":"', r.provider_id, '","rust_version":', coalesce('"' || r.rust_version || '"', 'null'), ',"vers":"', r.vers, '","yanked":', CASE WHEN r.yanked THEN 'true' ELSE 'false' END, '}}') AS line,
       row_number() OVER (ORDER BY e.ord, CAST(split_part(r.vers, '.', 1) AS INT), CAST(split_part(r.vers, '.', 2) AS INT)) - 1 AS n
FROM {releases} r JOIN {entities} e ON e.id = r.provider_id WHERE e.role = 'fork'
""")
def dataset_export(v: View) -> DataFrame:
    """The contract dataset as lines of JSON, by provider and version, and the places that they have in its files."""
    rows = v("releases").withColumn("kind", F.lit("registry-index"))
    versions = dataset.contract_versions(v("entities"), rows).join(v("entities").select(F.col("id").alias("provider_id"), "ord"), "provider_id")
    path, spark = shared_path(rows.sparkSession, "dataset-json"), rows.sparkSession
    writers.write_dataset_json(versions, path, [F.col("ord"), semver_key(F.col("vers"))], ["provider_id", "package", "kind", "vers", "yanked", "cksum", "rust_version"])
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.posexplode(F.split("value", "\n")).alias("at", "line")).where("line <> ''")
    firsts = lines.groupBy("file").agg(F.count("*").alias("lines"))
    before = F.coalesce(F.sum("lines").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each file
    return lines.join(firsts.select("file", before.alias("before")), "file").select("line", (F.col("before") + F.col("at")).alias("n"))


CURATED_SQL = """
SELECT 'markers' AS section, id AS provider_id, concat(ord, '.0.0|1.95.0|log ', id) AS held FROM {entities} WHERE role = 'fork'
UNION ALL SELECT 'probes', id, concat('kit-', ord, '|1.0.0|', id, '|builds|', CASE WHEN ord % 2 = 0 THEN 'slow' ELSE '' END) FROM {entities} WHERE role = 'fork'
UNION ALL SELECT 'sources', id, concat('org/', id, '|crates/', package, '|', CASE WHEN ord % 2 = 0 THEN 'v' ELSE '' END) FROM {entities} WHERE role = 'fork'
UNION ALL SELECT 'rules', id, concat('fn:a', ord, '>fn:b|', id, '@1.0.0#h1>', id, '@2.0.0#h2|', CASE WHEN ord % 2 = 0 THEN 'true' ELSE 'false' END) FROM {entities} WHERE role = 'fork'
"""


@query(CURATED_SQL)
def curated_sections_read(v: View) -> DataFrame:
    """Curated files of every fork: markers, probes, sources and rules, a document for each fork and section."""
    e = dataset.forks(v("entities"))
    spark, even = e.sparkSession, F.col("ord") % 2 == 0
    text = lambda *c: F.concat(*(F.lit(x) if isinstance(x, str) else x for x in c))
    one = lambda value: F.map_from_arrays(F.array("id"), F.array(value))
    named = lambda **c: F.struct(*(x.alias(k) for k, x in c.items()))
    side = lambda vers, h: named(provider=F.col("id"), version=F.lit(vers), api_hash=F.lit(h))
    marker = named(vers=text(F.col("ord").cast("string"), ".0.0"), toolchain=F.lit("1.95.0"), evidence=text("log ", F.col("id")))
    probe = named(kit=text("kit-", F.col("ord").cast("string")), kit_version=F.lit("1.0.0"), binds=F.col("id"), target=F.col("id"), outcome=F.lit("builds"), caveat=F.when(even, "slow"))
    source = named(repo=text("org/", F.col("id")), tree=text("crates/", F.col("package")), tag=F.when(even, "v"))
    rule = named(**{"id": F.col("id"), "from": named(key=text("fn:a", F.col("ord").cast("string"))), "to": named(key=F.lit("fn:b")), "transition": named(**{"from": side("1.0.0", "h1"), "to": side("2.0.0", "h2")}), "human_confirmed": even})
    written = {"markers": one(marker), "probes": F.array(probe), "sources": one(source), "rules": F.array(rule)}
    read = {name: readers.curated(spark, _write_lines(e.select(_object(**{name: value})), name), name, multi_line=False) for name, value in written.items()}
    held = {
        "markers": ("provider_id", F.concat_ws("|", "vers", "toolchain", "evidence")),
        "probes": ("binds", F.concat_ws("|", "kit", "kit_version", "target", "outcome", F.coalesce("caveat", F.lit("")))),
        "sources": ("provider_id", F.concat_ws("|", "repo", "tree", F.coalesce("tag", F.lit("")))),
        "rules": ("id", F.concat_ws("|", F.concat_ws(">", "from.key", "to.key"), F.concat_ws(">", *(F.concat(F.col(f"transition.{s}.provider"), F.lit("@"), F.col(f"transition.{s}.version"), F.lit("#"), F.col(f"transition.{s}.api_hash")) for s in ("from", "to"))), F.col("human_confirmed").cast("string"))),
    }
    rows = [read[name].select(F.lit(name).alias("section"), F.col(by).alias("provider_id"), c.alias("held")) for name, (by, c) in held.items()]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


@query("""
SELECT package, version, max_by(name, n) AS name FROM (
  SELECT package, concat(split_part(vers, '.', 1), '.', split_part(vers, '.', 2), '.0') AS version, concat(split_part(vers, '.', 1), '.', split_part(vers, '.', 2)) AS name, 1 AS n FROM {releases}
  UNION ALL SELECT package, concat(split_part(vers, '.', 1), '.', split_part(vers, '.', 2), '.0'), concat(split_part(vers, '.', 1), '.', split_part(vers, '.', 2), '.0'), 2 FROM {releases} WHERE k % 2 = 0)
GROUP BY package, version
""")
def toolchain_lists(v: View) -> DataFrame:
    """Releases as toolchains installed for each package; even ones list each version a second time in full, and the last counts."""
    r = v("releases").select("package", "k", F.concat_ws(".", F.split_part("vers", F.lit("."), F.lit(1)), F.split_part("vers", F.lit("."), F.lit(2))).alias("two"))
    lines = r.select("package", F.concat("two", F.lit("-x86_64-linux (default)")).alias("line"), F.lit(1).alias("ord")).union(r.where("k % 2 = 0").select("package", F.concat("two", F.lit(".0-x86_64-linux")), F.lit(2)))
    lines = lines.union(r.select("package", F.lit("stable-x86_64-linux"), F.lit(3)))
    return attest.installed_toolchains(lines, ["package"])


@query("""
SELECT e.id AS provider_id, 'registry-index' AS kind, r.package, r.vers, r.cksum, r.yanked, 2 * (row_number() OVER (PARTITION BY e.id ORDER BY r.vers) - 1) AS ord
FROM {entities} e JOIN {releases} r ON r.package = CASE WHEN e.role = 'companion' THEN concat('pkg-', e.ord - 1) ELSE e.package END
""")
def sources_read(v: View) -> DataFrame:
    """Every provider's source read by the adapter of its kind; companions name the package of the fork that they serve."""
    r = v("releases").select("package", F.col("vers").alias("at"), _object(vers=F.col("vers"), cksum=F.col("cksum"), yanked=F.col("yanked")))
    path = _write_lines(r.withColumn("json", F.concat("json", F.lit("\n"))), "registry", "package")
    other = F.when(F.col("role") == "companion", F.concat(F.lit("pkg-"), F.col("ord") - 1))
    source = F.struct(F.lit("registry-index").alias("kind"), other.alias("package"), F.lit(None).cast("string").alias("index_path"))
    config = v("entities").select("id", "package", F.array(source).alias("sources"))
    rows = adapters.read_sources(r.sparkSession, config, {"registry-index": path})
    return rows.select("provider_id", "kind", "package", "vers", "cksum", "yanked", F.col("ord").cast("long").alias("ord"))
