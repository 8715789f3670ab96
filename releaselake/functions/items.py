"""Surface items and package names as columns.

An item's key is ``kind:path::name``; kind ``use`` holds a re-export line instead of a name.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

USE = "use:"
NUL = "\0"


def sparse_path(package: Column) -> Column:
    """Where an index keeps a package: by its length, else by its first two pairs of letters; lower case."""
    p, n = F.lower(package), F.length(package)
    long = F.concat_ws("/", F.substring(p, 1, 2), F.substring(p, 3, 2), p)
    return F.when(n == 1, F.concat(F.lit("1/"), p)).when(n == 2, F.concat(F.lit("2/"), p)).when(n == 3, F.concat_ws("/", F.lit("3"), F.substring(p, 1, 1), p)).otherwise(long)


def library_name(declared: Column, package: Column) -> Column:
    """The declared name, or the package's with underscores; an empty declaration counts as none."""
    return F.coalesce(F.nullif(declared, F.lit("")), F.translate(package, "-", "_"))


def item_kind(key: Column) -> Column:
    return F.substring_index(key, ":", 1)


def item_name(key: Column) -> Column:
    """What follows the first colon; the whole key without one."""
    at = F.instr(key, ":")
    return F.when(at == 0, key).otherwise(F.substring(key, at + 1, F.length(key)))


def is_use(key: Column) -> Column:
    return key.startswith(USE)


def name_prefixes(name: Column, proper: bool = False) -> Column:
    """``a``, ``a::b``, ``a::b::c`` of a path; without the whole path if ``proper``."""
    parts = F.split(name, "::")
    top = F.size(parts) - 1 if proper else F.size(parts)
    steps = F.when(top < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.greatest(top, F.lit(1))))
    return F.transform(steps, lambda n: F.array_join(F.slice(parts, 1, n), "::"))


def renamed(key: Column, target: Column, alias: Column) -> Column:
    """The key with the selected path replaced by an alias; ``_`` and no alias leave it."""
    new = F.concat(item_kind(key), F.lit(":"), alias, F.substring(item_name(key), F.length(target) + 1, F.length(key)))
    return F.when(alias.isNotNull() & (alias != "_"), new).otherwise(key)


def joined_gates(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def surface_hash(key: Column, digest: Column, cfg: Column) -> Column:
    """Aggregate: SHA-256 over a surface's items in order of (key, digest, cfg), whatever order they come in; missing parts count as empty."""
    none = F.array().cast("array<string>")
    item = F.struct(F.coalesce(key, F.lit("")).alias("key"), F.coalesce(digest, F.lit("")).alias("digest"), F.coalesce(cfg, none).alias("cfg"))
    text = lambda i: F.concat(i["key"], F.lit(NUL), i["digest"], F.lit(NUL), F.array_join(i["cfg"], "|"))
    return F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(item)), text), NUL).cast("binary"), 256)
