"""Sources of releases by their kind. Each kind has an adapter; a config that names another kind is an error before anything is read.

``registry-index`` is a data source of its own: a folder with a file for each package under its index path (or in a folder ``package=<name>``), a line of JSON for each version. It
is read in partitions of about equal size, by batches or as a stream of the files that changed, from any store that Arrow opens by its address."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition

from ..functions.items import sparse_path
from .readers import ROW

LINES = "index_path string, ord int, line string"
PARTITION_BYTES = 32 << 20
FILE_BYTES = 64 << 10  # what opening a file counts for
BATCH = 4_096


@dataclass
class Files(InputPartition):
    """Addresses of files within a root."""

    root: str
    paths: list[str]

    def __post_init__(self) -> None:
        super().__init__(self.paths)


def opened(root: str):
    """A file system and the root's path there."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root) if "://" in root or root.startswith("file:") else (fs.LocalFileSystem(), root)


def listed(root: str) -> list[tuple[str, int, int]]:
    """(path within the root, bytes, time of change in nanoseconds) of the files that are not hidden."""
    from pyarrow import fs

    store, top = opened(root)
    found = store.get_file_info(fs.FileSelector(top, recursive=True))
    inside = [(f.path[len(top.rstrip("/")) + 1 :], f.size, int(f.mtime_ns or 0)) for f in found if f.type == fs.FileType.File]
    return sorted(x for x in inside if not any(p[0] in "._" for p in x[0].split("/")))


def partitioned(root: str, files: list[tuple[str, int, int]]) -> list[Files]:
    """Files dealt out in order, each partition up to ``PARTITION_BYTES``."""
    out, held = [], PARTITION_BYTES
    for path, size, _ in files:
        if held + size + FILE_BYTES > PARTITION_BYTES:
            out.append(Files(root, []))
            held = 0
        out[-1].paths.append(path)
        held += size + FILE_BYTES
    return out


def lines_of(partition: Files) -> Iterator[pa.RecordBatch]:
    """The lines that are not blank, with their places in their files."""
    store, top = opened(partition.root)
    held: list[tuple[str, int, str]] = []

    def batch() -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held), (pa.string(), pa.int32(), pa.string()))], ["index_path", "ord", "line"])

    for path in partition.paths:
        with store.open_input_stream(f"{top.rstrip('/')}/{path}") as f:
            for ord_, line in enumerate(io.TextIOWrapper(f, encoding="utf-8", newline="\n")):
                if line.strip():
                    held.append((path, ord_, line.rstrip("\n")))
                if len(held) >= BATCH:
                    yield batch()
                    held.clear()
    if held:
        yield batch()


class IndexReader(DataSourceReader):
    def __init__(self, root: str):
        self.root, self.only = root, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Files are left out by their path; all other filters stay with Spark."""
        for f in filters:
            values = [f.value] if isinstance(f, EqualTo) else list(f.value) if isinstance(f, In) else None
            if values is None or f.attribute != ("index_path",):
                yield f
            else:
                self.only = set(values) if self.only is None else self.only & set(values)

    def partitions(self) -> list[Files]:
        files = [f for f in listed(self.root) if self.only is None or f[0] in self.only]
        return partitioned(self.root, files) or [Files(self.root, [])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return lines_of(partition)


class IndexStream(DataSourceStreamReader):
    """Files by the time of their last change; one that changed again comes again, whole."""

    def __init__(self, root: str):
        self.root = root

    def initialOffset(self) -> dict[str, Any]:
        return {"changed": 0}

    def latestOffset(self) -> dict[str, Any]:
        return {"changed": max((t for _, _, t in listed(self.root)), default=0)}

    def partitions(self, start: dict[str, Any], end: dict[str, Any]) -> list[Files]:
        return partitioned(self.root, [f for f in listed(self.root) if start["changed"] < f[2] <= end["changed"]])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        return lines_of(partition)

    def commit(self, end: dict[str, Any]) -> None:
        pass


class RegistryIndex(DataSource):
    """``index_path``, ``ord``, ``line`` of the files below the option ``path``."""

    @classmethod
    def name(cls) -> str:
        return "registry-index"

    def schema(self) -> str:
        return LINES

    def reader(self, schema) -> IndexReader:
        return IndexReader(self.options["path"])

    def streamReader(self, schema) -> IndexStream:
        return IndexStream(self.options["path"])


Adapter = Callable[[SparkSession, str, DataFrame], DataFrame]
ADAPTERS: dict[str, Adapter] = {}


def adapter(kind: str) -> Callable[[Adapter], Adapter]:
    """Register a function of (session, address, sources) for a kind; ``sources(provider_id, package, index_path)`` are those of that kind. It returns provider_id and registry rows."""

    def register(f: Adapter) -> Adapter:
        ADAPTERS[kind] = f
        return f

    return register


def typed(lines: DataFrame) -> DataFrame:
    """The registry rows of lines, with the index path that each file stands for."""
    folder = F.regexp_extract("index_path", r"(?:^|/)package=([^/]+)/", 1)
    path = F.when(folder != "", sparse_path(folder)).otherwise(F.col("index_path"))
    return lines.select(path.alias("index_path"), "ord", F.from_json("line", ROW).alias("r")).select("index_path", "ord", "r.*")


def registered(spark: SparkSession) -> None:
    """Make the data sources of this module known to a session, and let filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RegistryIndex)


@adapter("registry-index")
def registry_index(spark: SparkSession, address: str, sources: DataFrame) -> DataFrame:
    registered(spark)
    lines = spark.read.format("registry-index").option("path", address).load()
    return typed(lines).join(sources, "index_path").drop("index_path")


def registry_stream(spark: SparkSession, address: str) -> DataFrame:
    """The registry rows of files as they change."""
    registered(spark)
    return typed(spark.readStream.format("registry-index").option("path", address).load())


def sources_of(config: DataFrame) -> DataFrame:
    """provider_id, kind, package, index_path: a row for each source of ``config(id, package, sources)``. A source's own package and path come before the provider's."""
    flat = config.select(F.col("id").alias("provider_id"), F.col("package").alias("_package"), F.explode("sources").alias("s"))
    package = F.coalesce(F.nullif("s.package", F.lit("")), F.col("_package"))
    return flat.select("provider_id", F.col("s.kind").alias("kind"), package.alias("package"), F.coalesce(F.nullif("s.index_path", F.lit("")), sparse_path(package)).alias("index_path"))


def read_sources(spark: SparkSession, config: DataFrame, addresses: dict[str, str]) -> DataFrame:
    """provider_id, kind and the registry rows of every source of a config, each read by the adapter of its kind from that kind's address."""
    sources = sources_of(config)
    kinds = sorted(str(r.kind) for r in sources.select("kind").distinct().limit(len(ADAPTERS) + 1).collect())
    for kind in kinds:
        if kind not in ADAPTERS:
            raise ValueError(f"no adapter for source kind {kind} (known: {', '.join(sorted(ADAPTERS))})")
    out = None
    for kind in kinds:
        rows = ADAPTERS[kind](spark, addresses[kind], sources.where(F.col("kind") == kind).drop("kind")).withColumn("kind", F.lit(kind))
        out = rows if out is None else out.unionByName(rows)
    return spark.createDataFrame([], f"provider_id string, package string, ord int, {ROW}, kind string") if out is None else out
