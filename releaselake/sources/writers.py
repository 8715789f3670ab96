"""Sinks. Flat Parquet holds the truth; nested JSON lines are an export: each line is a document with one provider or entry, keys in order and no white space."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..operators.index import nested


def _ordered(c: Column, kind: DataType) -> Column:
    """The value with the fields and keys of every level in name order."""
    if isinstance(kind, StructType):
        inner = F.struct(*(_ordered(c.getField(f.name), f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)))
        return F.when(c.isNotNull(), inner)
    if isinstance(kind, ArrayType):
        return F.transform(c, lambda x: _ordered(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.map_from_entries(F.transform(F.array_sort(F.map_keys(c)), lambda k: F.struct(k, _ordered(F.try_element_at(c, k), kind.valueType))))
    return c


def canonical_json(df: DataFrame) -> DataFrame:
    """One column ``json``: each row's fields in name order at every level, nulls written."""
    return df.select(F.to_json(_ordered(F.struct(*df.columns), df.schema), {"ignoreNullFields": "false"}).alias("json"))


def index_documents(releases: DataFrame, providers: DataFrame | None = None, schema: str = "index.v1") -> DataFrame:
    """id, ord (if the providers have it), document: a document for each provider, with its sources and their releases.

    ``providers(ord, id, package, repository, description)`` may hold more columns, which are in the document too, and providers without releases."""
    n = nested(releases).withColumnRenamed("provider_id", "id")
    if providers is not None:
        n = providers.join(n, "id", "left")
    n = n.withColumn("sources", F.coalesce("sources", F.array().cast(n.schema["sources"].dataType)))
    fields = [c for c in n.columns if c != "ord"]
    held = [c for c in ("ord", "id") if c in n.columns]
    return n.select(*held, F.struct(F.lit(schema).alias("schema"), F.array(F.struct(*fields)).alias("providers")).alias("document"))


def index_lines(releases: DataFrame, providers: DataFrame | None = None, schema: str = "index.v1") -> DataFrame:
    """id, json: the canonical line of each provider, as ``published`` takes them."""
    d = index_documents(releases, providers, schema)
    return d.select("id", F.to_json(_ordered(F.col("document"), d.schema["document"].dataType), {"ignoreNullFields": "false"}).alias("json"))


def write_index(releases: DataFrame, path: str, providers: DataFrame | None = None, schema: str = "index.v1") -> None:
    """Key-sorted, compact, gzipped lines, each a document with one provider, in config order, else in order of their ids."""
    d = index_documents(releases, providers, schema)
    order = ["ord", "id"] if "ord" in d.columns else ["id"]
    canonical_json(d.orderBy(*order).select("document.*")).write.mode("overwrite").option("compression", "gzip").text(path)


def write_dataset(versions: DataFrame, path: str) -> None:
    """Files by ranges of providers, in order inside, so that one provider is found by the statistics of its file and the number of files goes with the rows, not with the providers."""
    versions.repartitionByRange("provider_id").sortWithinPartitions("provider_id", "vers").write.mode("overwrite").parquet(path)


def write_dataset_json(versions: DataFrame, path: str, order: list[Column], fields: list[str]) -> None:
    """The dataset as gzipped canonical lines with the given fields, a release each, in one order over all files."""
    canonical_json(versions.orderBy(*order).select(*fields)).write.mode("overwrite").option("compression", "gzip").text(path)


def write_attestations(index: DataFrame, path: str, environment: DataFrame, schema: str = "attestations.v1") -> None:
    """Lines in order of package and version, each a document with one entry, its schema tag and the environment (one row)."""
    fields = [c for c in index.columns if c not in ("package", "vers", "origin")]
    here = F.broadcast(environment.limit(1).select(F.struct(*environment.columns).alias("environment")))
    entry = F.map_from_arrays(F.array(F.concat_ws("/", "package", "vers")), F.array(F.struct(*fields)))
    lines = index.crossJoin(here).orderBy("package", "vers").select(F.lit(schema).alias("schema"), "environment", entry.alias("entries"))
    canonical_json(lines).write.mode("overwrite").text(path)
