"""Surface hashes of releases of any size: items come sorted and run through one digest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.items import NUL


def surface_hashes(items: DataFrame, by: list[str]) -> DataFrame:
    """``by``, items, api_hash for each group of ``items(key, digest, cfg)`` named by the string columns ``by``: the value of the aggregate ``surface_hash``, but a
    group is streamed through one task in order of (key, digest, cfg), a batch of rows held at a time, and what the sort cannot hold it spills."""
    none = F.array().cast("array<string>")
    key, digest, cfg = (F.coalesce(F.col(c), x).alias(c) for c, x in (("key", F.lit("")), ("digest", F.lit("")), ("cfg", none)))
    text = F.concat("key", F.lit(NUL), "digest", F.lit(NUL), F.array_join("cfg", "|")).cast("binary")
    rows = items.select(*by, key, digest, cfg).repartition(*by).sortWithinPartitions(*by, "key", "digest", "cfg").select(*by, text.alias("text"))
    kinds = [*([pa.string()] * len(by)), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, count, hashed = None, 0, hashlib.sha256()
        for batch in batches:
            done, texts = [], batch.column("text").to_pylist()
            groups = list(zip(*(batch.column(c).to_pylist() for c in by)))
            cuts = [0, *(i for i in range(1, len(groups)) if groups[i] != groups[i - 1]), len(groups)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if groups[lo] != group:
                    if group is not None:
                        done.append((*group, count, hashed.hexdigest()))
                    group, count, hashed = groups[lo], 0, hashlib.sha256()
                hashed.update((b"\0" if count else b"") + b"\0".join(texts[lo:hi]))
                count += hi - lo
            if done:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*done), kinds)], [*by, "items", "api_hash"])
        if group is not None:
            yield pa.record_batch([pa.array([v], t) for v, t in zip((*group, count, hashed.hexdigest()), kinds)], [*by, "items", "api_hash"])

    return rows.mapInArrow(run, ", ".join([*(f"{c} string" for c in by), "items long", "api_hash string"]))
