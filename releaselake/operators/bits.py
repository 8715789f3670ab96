"""Comparisons of many releases by bitmaps: a bit for each release of a package, in version order.

Words of 64 bits hold in which releases a key stands, with which digest and gates. A release's neighbour is the next bit, so that what was added, removed, re-signed or regated
in any release, and which releases fit, comes out of and, or and shift over words, without a join for each release."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.versions import semver_key

WORD = 64


def numbered(releases: DataFrame) -> DataFrame:
    """package, vers, n: the place of each release in version order."""
    order = Window.partitionBy("package").orderBy(semver_key(F.col("vers")), "vers")
    return releases.select("package", "vers").distinct().select("package", "vers", (F.row_number().over(order) - 1).alias("n"))


def _at(n: Column) -> tuple[Column, Column]:
    """The word that holds a release's bit, and the word with that bit alone."""
    return F.floor(n / WORD).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (n % WORD).cast("int"))


def both(a: Column, b: Column) -> Column:
    return a.bitwiseAND(b)


def without(a: Column, b: Column) -> Column:
    return a.bitwiseAND(F.bitwise_not(b))


def words(items: DataFrame, numbers: DataFrame, keys: list[str]) -> DataFrame:
    """package, ``keys``, word, now, before: in which releases the keys stand, and in which they stood in the release before."""
    placed = items.join(numbers, ["package", "vers"])
    none = F.lit(0).cast("long")
    (here, bit), (there, next_bit) = _at(F.col("n")), _at(F.col("n") + 1)
    sides = F.array(F.struct(here.alias("word"), bit.alias("now"), none.alias("before")), F.struct(there.alias("word"), none.alias("now"), next_bit.alias("before")))
    rows = placed.select("package", *keys, F.explode(sides).alias("s")).select("package", *keys, "s.*")
    return rows.groupBy("package", *keys, "word").agg(F.bit_or("now").alias("now"), F.bit_or("before").alias("before"))


def _compared(items: DataFrame, numbers: DataFrame) -> DataFrame:
    """package, key, word, added, removed, resigned, regated: bits of releases. What follows the last release is none."""
    same = words(items, numbers, ["key", "digest", "cfg"]).withColumn("same", both(F.col("now"), F.col("before")))
    signed = same.groupBy("package", "key", "digest", "word").agg(F.bit_or("now").alias("now"), F.bit_or("before").alias("before"), F.bit_or("same").alias("same")).withColumn("signed", both(F.col("now"), F.col("before")))
    whole = signed.groupBy("package", "key", "word").agg(*(F.bit_or(c).alias(c) for c in ("now", "before", "same", "signed")))
    there = numbers.select("package", *(c.alias(a) for c, a in zip(_at(F.col("n")), ("word", "bit")))).groupBy("package", "word").agg(F.bit_or("bit").alias("there"))
    first = F.when(F.col("word") == 0, F.lit(-2).cast("long")).otherwise(F.lit(-1).cast("long"))  # the first release has none before
    out = whole.join(there, ["package", "word"])
    now, before = F.col("now"), F.col("before")
    kept = both(now, before)
    return out.select("package", "key", "word", both(without(now, before), first).alias("added"), both(without(before, now), F.col("there")).alias("removed"), without(kept, F.col("signed")).alias("resigned"), without(both(kept, F.col("signed")), F.col("same")).alias("regated"))


def _bits(word: Column) -> Column:
    """The places of the bits that are set."""
    return F.filter(F.sequence(F.lit(0), F.lit(WORD - 1)), lambda i: F.call_function("getbit", word, i) == 1)


def release_delta(items: DataFrame, releases: DataFrame) -> DataFrame:
    """package, vers, key, change: what ``analyze.release_delta`` gives, for items that stand in many releases. ``items(package, vers, key, digest, cfg)`` has each key once in a release."""
    numbers = numbered(releases)
    kinds = {"added": "added", "removed": "removed", "resigned": "re-signed", "regated": "regated"}
    change = F.array(*(F.struct(F.lit(name).alias("change"), F.col(c).alias("bits")) for c, name in kinds.items()))
    rows = _compared(items, numbers).select("package", "key", "word", F.explode(change).alias("c")).where("c.bits <> 0")
    found = rows.select("package", "key", "c.change", F.explode(F.transform(_bits(F.col("c.bits")), lambda i: F.col("word") * WORD + i)).alias("n"))
    return found.join(numbers, ["package", "n"]).select("package", "vers", "key", "change")


def first_removed(items: DataFrame, releases: DataFrame) -> DataFrame:
    """package, key, vers: the first release that removed a key, the lowest bit of its removals."""
    numbers = numbered(releases)
    word = F.col("removed")
    low = F.bit_count(both(word, -word) - 1)  # the zeros below the lowest bit
    gone = _compared(items, numbers).where("removed <> 0").groupBy("package", "key").agg(F.min(F.col("word") * WORD + low).alias("n"))
    return gone.join(numbers, ["package", "n"]).select("package", "key", "vers")


def used_api_report(used: DataFrame, items: DataFrame, baseline: DataFrame) -> DataFrame:
    """package, vers, checkable, unprovable, intact, missing, resigned, compatible: what ``analyze.used_api_report`` gives. Symbols are summed bit by bit over words; a release
    is compatible if the bits of all checkable symbols have it.

    ``used(package, key)``, ``items(package, vers, key, digest)``, ``baseline(package, vers)``; of several digests of a key in a release the least counts."""
    numbers = numbered(items)
    wanted = items.join(used.select("package", "key").distinct(), ["package", "key"], "left_semi").groupBy("package", "vers", "key").agg(F.min("digest").alias("digest"))
    base = wanted.join(baseline, ["package", "vers"], "left_semi").groupBy("package", "key").agg(F.min("digest").alias("base"))
    counts = used.select("package", "key").distinct().join(base, ["package", "key"], "left").groupBy("package").agg(F.count("base").alias("checkable"), F.count_if(F.col("base").isNull()).alias("unprovable"))
    here, bit = _at(F.col("n"))
    placed = wanted.join(base, ["package", "key"]).join(numbers, ["package", "vers"])
    symbol = placed.groupBy("package", "key", here.alias("word")).agg(F.bit_or(bit).alias("seen"), F.bit_or(F.when(F.col("digest") == F.col("base"), bit).otherwise(0)).alias("intact"))
    each = lambda c: F.array(*(F.sum(F.call_function("getbit", F.col(c), F.lit(i)).cast("long")) for i in range(WORD))).alias(c)
    per = symbol.groupBy("package", "word").agg(each("seen"), each("intact"), F.bit_and("intact").alias("all"), F.count("*").alias("symbols"))
    flat = per.select("package", "word", "all", "symbols", F.posexplode(F.arrays_zip("seen", "intact")).alias("i", "x"))
    fits = (F.call_function("getbit", F.col("all"), F.col("i")) == 1)
    of_release = flat.select("package", (F.col("word") * WORD + F.col("i")).alias("n"), "x.seen", "x.intact", fits.alias("all"), "symbols")
    rows = numbers.join(counts, "package").join(of_release, ["package", "n"], "left")
    intact, there = F.coalesce("intact", F.lit(0)), F.coalesce("seen", F.lit(0))
    compatible = (F.col("checkable") == 0) | (F.coalesce("all", F.lit(False)) & (F.coalesce("symbols", F.lit(0)) == F.col("checkable")))
    return rows.select("package", "vers", "checkable", "unprovable", intact.alias("intact"), (F.col("checkable") - there).alias("missing"), (there - intact).alias("resigned"), compatible.alias("compatible"))
