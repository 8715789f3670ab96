"""Version strings as columns: two orders that differ on purpose.

``padded`` and ``plain_key`` know one to three numbers and nothing else (declared floors, toolchains); ``semver_key`` is full
precedence with pre-releases (releases). Each gives null for what it does not know.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEMVER = r"^([0-9]+)\.([0-9]+)\.([0-9]+)(?:-([0-9A-Za-z.-]+))?(?:\+[0-9A-Za-z.-]+)?$"


def padded(version: Column) -> Column:
    """``1.85`` as ``1.85.0``; null unless it is one to three numbers, spaces around aside."""
    v = F.trim(version)
    parts = F.split(v, r"\.")
    return F.when(v.rlike(r"^[0-9]+(\.[0-9]+){0,2}$"), F.array_join(F.concat(parts, F.array_repeat(F.lit("0"), F.lit(3) - F.size(parts))), "."))


def plain_key(version: Column) -> Column:
    """Three numbers to compare by, without what follows ``-`` or ``+``."""
    core = padded(F.regexp_replace(F.regexp_replace(F.trim(version), "-.*$", ""), r"\+.*$", ""))
    return F.transform(F.split(core, r"\."), lambda x: x.cast("long"))


def semver_key(version: Column) -> Column:
    """A struct in the order of semantic versions: numbers, stable after pre-releases, then their parts, numbers before words."""
    number = lambda i: F.regexp_extract(version, SEMVER, i).cast("long")
    pre = F.regexp_extract(version, SEMVER, 4)
    part = lambda x: F.struct((~x.rlike("^[0-9]+$")).alias("word"), F.coalesce(x.try_cast("long"), F.lit(0)).alias("n"), x.alias("s"))
    parts = F.when(pre == "", F.array().cast("array<struct<word:boolean,n:bigint,s:string>>")).otherwise(F.transform(F.split(pre, r"\."), part))
    return F.when(version.rlike(SEMVER), F.struct(number(1).alias("major"), number(2).alias("minor"), number(3).alias("patch"), (pre == "").alias("stable"), parts.alias("pre")))


def is_prerelease(version: Column) -> Column:
    return F.regexp_extract(version, SEMVER, 4) != ""


def compiler_version(line: Column) -> Column:
    """The first of a version line's first two words that is a full version, a trailing comma aside; null without one."""
    words = F.transform(F.slice(F.split(F.trim(line), r"\s+"), 1, 2), lambda w: F.regexp_replace(w, ",+$", ""))
    return F.get(F.filter(words, lambda w: w.rlike(SEMVER)), 0)


def installed_toolchain(line: Column) -> Column:
    """(version, name) of a line of installed toolchains; null for channels and for lines without a ``-target``."""
    word = F.get(F.split(F.trim(line), r"\s+"), 0)
    name = F.regexp_extract(word, r"^([^-]+)-.+$", 1)
    return F.when(padded(name).isNotNull(), F.struct(padded(name).alias("version"), name.alias("name")))
