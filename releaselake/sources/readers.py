"""Readers of registry rows, API metadata, configs, indexes, analysis rows, curated files and documents, with explicit schemas.

Only Spark opens paths, so that any store it knows works. A path that does not exist reads as empty where the docstring says so. Files of
one package each are named by it, or lie in a folder ``package=<name>`` as Spark writes them. ``multi_line`` tells whether a file is one document
or a document for each line, which large exports are; indexes are read either way.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keep import keep_last

DEP = "struct<name:string,req:string,optional:boolean,default_features:boolean,kind:string>"
ROW = f"vers string, cksum string, yanked boolean, features map<string,array<string>>, deps array<{DEP}>"
API = "crate struct<repository:string,description:string>, versions array<struct<num:string,rust_version:string,created_at:string>>"
PROVIDER = (
    "struct<id:string,package:string,lib_name:string,role:string,`for`:string,repository:string,note:string,exclude:array<string>,"
    "surface_source:struct<kind:string,`from`:array<string>>,sources:array<struct<kind:string,package:string,index_path:string>>>"
)
CONFIG = f"contract struct<id:string,description:string>, recommended_provider string, providers array<{PROVIDER}>"
RELEASE = f"struct<id:string,meta:struct<yanked:boolean,cksum:string,rust_version:string,created_at:string,feature_names:array<string>,deps:array<{DEP}>>,artifact:struct<blob:string,sha256:string,format:string>>"
INDEX = f"schema string, providers array<struct<id:string,package:string,repository:string,description:string,sources:array<struct<kind:string,releases:array<{RELEASE}>>>>>"
ITEM = "struct<key:string,digest:string,cfg:array<string>,text:string,doc:string,members:string,src:struct<file:string,start:int,`end`:int>>"
ANALYSIS = f"rows array<struct<package:string,vers:string,surface:array<{ITEM}>>>"
CURATED = {
    "companions": "companions map<string,struct<package:string,pin:string,features:array<string>,note:string>>",
    "markers": "markers map<string,struct<vers:string,toolchain:string,evidence:string>>",
    "probes": "probes array<struct<kit:string,kit_version:string,binds:string,target:string,outcome:string,caveat:string,evidence:string>>",
    "sources": "sources map<string,struct<repo:string,tree:string,tag:string,note:string>>",
    "notes": "notes array<struct<provider:string,versions:array<string>,below:string,note:string>>",
    "rules": "rules array<struct<id:string,`from`:struct<key:string>,`to`:struct<key:string>,transition:struct<`from`:struct<provider:string,version:string,api_hash:string>,`to`:struct<provider:string,version:string,api_hash:string>>,human_confirmed:boolean,note:string>>",
}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _json(spark: SparkSession, path: str, schema: str, strict: bool = False, multi_line: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", "FAILFAST" if strict else "PERMISSIVE").json(path)


def _documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that are one document each, or a document for each line. No file is no document; with an unreadable line or file there is none either, and a warning."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    bad = "_unreadable"
    parsed = lambda c: F.from_json(c, f"{schema}, {bad} string", {"columnNameOfCorruptRecord": bad})
    lines = spark.read.text(path).where(F.trim("value") != "").select(parsed(F.col("value")).alias("d"))
    if lines.where(F.col(f"d.{bad}").isNotNull()).isEmpty():
        return lines.select("d.*").drop(bad)
    first = parsed(F.regexp_extract("value", r"^\s*([^\n]*)", 1))
    files = spark.read.text(path, wholetext=True).where(F.trim("value") != "").select(parsed(F.col("value")).alias("d"), first[bad].isNotNull().alias("spread"))
    if files.where(F.col(f"d.{bad}").isNotNull() | ~F.col("spread")).isEmpty():
        return files.select("d.*").drop(bad)
    warnings.warn(f"{path} is unreadable and taken as empty", stacklevel=3)
    return spark.createDataFrame([], schema)


def _file_package() -> Column:
    """The package that a file is about."""
    folder = F.nullif(F.regexp_extract("_metadata.file_path", r"/package=([^/]+)/[^/]*$", 1), F.lit(""))
    return F.coalesce(folder, F.regexp_extract("_metadata.file_name", r"^(.*?)(\.json)?$", 1))


def registry_rows(spark: SparkSession, path: str) -> DataFrame:
    """Lines of JSON, one for each version, blank lines left out; ``ord`` is the line's place in its file, ``package`` the file's name.

    A file holds one package's versions and is read as one value, which keeps their order without a shuffle."""
    text = spark.read.text(path, wholetext=True).select(_file_package().alias("package"), F.posexplode(F.split("value", "\n")).alias("ord", "line"))
    return text.where(F.trim("line") != "").select("package", "ord", F.from_json("line", ROW).alias("r")).select("package", "ord", "r.*")


def api_versions(spark: SparkSession, path: str) -> DataFrame:
    """package, num, rust_version, created_at; of versions listed twice the last counts."""
    raw = _json(spark, path, API).select(_file_package().alias("package"), F.posexplode("versions").alias("ord", "v"))
    return keep_last(raw.select("package", "ord", "v.*"), ["package", "num"], "ord").drop("ord")


def api_packages(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, API).select(_file_package().alias("package"), F.lit(0).alias("ord"), "crate.*")


def provider_config(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Providers in config order, as the checks and the sync take them, with the id of their contract."""
    rows = _json(spark, path, CONFIG, strict=True, multi_line=multi_line).select(F.col("contract.id").alias("contract_id"), F.posexplode("providers").alias("ord", "p")).select("contract_id", "ord", "p.*")
    return rows.withColumnRenamed("for", "served_id").withColumn("is_facade", F.col("surface_source").isNotNull()).select("*", F.col("surface_source.kind").alias("surface_kind"), F.col("surface_source.from").alias("surface_from")).drop("surface_source")


def corpus_index(spark: SparkSession, path: str) -> DataFrame:
    """The nested index as flat releases; of releases listed twice the last counts. No file is an empty index, and so is an unreadable one, with a warning."""
    source = _documents(spark, path, INDEX)
    a = source.select(F.posexplode("providers").alias("po", "p")).select("po", F.col("p.id").alias("provider_id"), F.col("p.package").alias("package"), F.posexplode("p.sources").alias("so", "s"))
    b = a.select("provider_id", "package", F.col("s.kind").alias("kind"), "po", "so", F.posexplode("s.releases").alias("ord", "r"))
    flat = b.select("provider_id", "package", "kind", F.struct("po", "so", "ord").alias("_place"), "ord", F.col("r.id").alias("id"), "r.meta.*", F.col("r.artifact").alias("artifact"), F.col("r.artifact.blob").alias("blob"))
    return keep_last(flat, ["provider_id", "kind", "id"], "_place").drop("_place")


def index_providers(spark: SparkSession, path: str) -> DataFrame:
    return _documents(spark, path, INDEX).select(F.explode("providers").alias("p")).select("p.id", "p.package", "p.repository", "p.description")


def analysis_surfaces(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """package, vers, surface: a null surface is measured and empty; of rows for one release the last counts."""
    rows = _json(spark, path, ANALYSIS, multi_line=multi_line).select(F.posexplode("rows").alias("ord", "r")).select("ord", "r.package", "r.vers", F.coalesce("r.surface", F.array().cast(f"array<{ITEM}>")).alias("surface"))
    return keep_last(rows, ["package", "vers"], "ord").drop("ord")


def surface_items(surfaces: DataFrame) -> DataFrame:
    """An item a row, with its place; missing digests and gates are empty."""
    flat = surfaces.select("package", "vers", F.posexplode("surface").alias("pos", "i")).select("package", "vers", "pos", "i.*")
    return flat.withColumn("cfg", F.coalesce("cfg", F.array().cast("array<string>"))).withColumn("digest", F.coalesce("digest", F.lit("")))


def curated(spark: SparkSession, path: str, section: str, multi_line: bool = True) -> DataFrame:
    """A section of the curated files as rows, maps with their key as ``provider_id``, lists with ``ord``. No file is an empty section; a malformed one fails."""
    schema = CURATED[section]
    source = _json(spark, path, schema, strict=True, multi_line=multi_line) if exists(spark, path) else spark.createDataFrame([], schema)
    if " map<" in schema:
        return source.select(F.explode(section).alias("provider_id", "x")).select("provider_id", "x.*")
    return source.select(F.posexplode(section).alias("ord", "x")).select("ord", "x.*")


def companions(rows: DataFrame) -> DataFrame:
    """Curated companions with the pin as ``pin_kind`` and ``pin_fixed``: a text is its kind, an object names the fixed version."""
    fixed = F.get_json_object("pin", "$.fixed")
    return rows.withColumn("pin_kind", F.when(fixed.isNotNull(), "fixed").otherwise(F.col("pin"))).withColumn("pin_fixed", fixed).drop("pin")


def release_blobs(spark: SparkSession, path: str) -> DataFrame:
    """package, vers, content of ``<package>/<vers>.tar.gz`` files."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar.gz").option("recursiveFileLookup", True).load(path)
    return raw.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("package"), F.regexp_extract("path", r"/([^/]+)\.tar\.gz$", 1).alias("vers"), "content")


def attestation_docs(spark: SparkSession, path: str) -> DataFrame:
    """kind, package, vers, sha256, schema of ``<kind>/<package>/<vers>.json`` files, or of files in folders ``kind=<kind>/package=<name>/vers=<vers>``; the schema of an unreadable one is null."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(path)
    folder = r"(?:/kind=([^/]+)/package=([^/]+)/vers=([^/]+))?/[^/]*$"
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract("path", folder, i), F.lit("")), F.regexp_extract("path", r"([^/]+)/([^/]+)/([^/]+)\.json$", i))
    return raw.select(part(1).alias("kind"), part(2).alias("package"), part(3).alias("vers"), F.sha2("content", 256).alias("sha256"), F.get_json_object(F.decode("content", "UTF-8"), "$.schema").alias("schema"))


ARCHIVED = "kind string, package string, vers string, text string"


def attestation_archive(spark: SparkSession, path: str) -> DataFrame:
    """The same columns of files that hold many documents: lines of kind, package, vers and the document's whole text, whose digest counts. A folder of single documents makes the driver list a file for each."""
    rows = _json(spark, path, ARCHIVED, multi_line=False)
    return rows.select("kind", "package", "vers", F.sha2(F.col("text").cast("binary"), 256).alias("sha256"), F.get_json_object("text", "$.schema").alias("schema"))


DOC = "struct<sha256:string,schema:string>"
ENTRY = f"struct<cksum:string,lock:string,floor:string,tvm:{DOC},eac:{DOC}>"
ATTESTATIONS = "schema string, environment struct<tool:string,rustc:string,rustdoc:string>, entries map<string,string>"


def attestation_index(spark: SparkSession, path: str) -> DataFrame:
    """Entries: package, vers, their fields, and the schema tag and environment of the document that each stands in; those that are no objects are left out. No file is an
    empty index, and so is an unreadable one, with a warning."""
    source = _documents(spark, path, ATTESTATIONS)
    at = F.instr("key", "/")
    rows = source.select("schema", "environment", F.explode("entries").alias("key", "x")).where(F.trim("x").startswith("{"))
    package = F.expr("substring(key, 1, instr(key, '/') - 1)")
    entries = rows.select(package.alias("package"), F.substring("key", at + 1, F.length("key")).alias("vers"), F.from_json("x", ENTRY).alias("e"), "schema", "environment")
    return entries.select("package", "vers", "e.*", "schema", "environment")
