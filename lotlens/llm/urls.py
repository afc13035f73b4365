"""URL rules by a Bloom filter cascade, in DataFrame functions alone.

A rule is (host, path, verdict); it fits its host and all subdomains where the path starts
with the rule's, the longest fitting rule wins. Every url has one candidate key per shape of the rules (so many
labels of the host's end, so many characters of the path's start). The
distinct candidate keys of all urls are the key universe. A cascade holds a subset of a
universe exactly: level 1 is a Bloom filter of the listed keys; level 2 one of those
unlisted keys of the universe that level 1 lets through; level 3 one of the
listed keys that level 2 lets through; and so on until none is left. A key of
the universe is listed if the first level that does not know it has an even number (all
know it: as the last level says). The first cascade tells which keys are rules, the second which of these block.

Filters are sized by the lists, not by the universe: level 1 takes as many bits per
key as make its false positives about as many as the listed keys, so the filters, which are literals in the
plan, are bounded by the rules (MAX_BITS is checked).

Edges: a null url or one without `://` has an empty host and path; such rows fit only a rule of an empty host
(none can be given), so their rule is null and the verdict that of the method for unlisted keys, allow; repeated urls and ids are
judged each for itself; an empty table of pages or of rules gives an empty result or
no rule for any row; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bits of one level at most (a literal of 8 MB).
MAX_BITS = 1 << 26
LEVEL_BITS = 1.44  # bits per key and halving of the false positive rate


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    rest = F.split_part(F.split_part(F.coalesce(rest, F.lit("")), F.lit("#"), F.lit(1)), F.lit("?"), F.lit(1))
    host = F.split_part(rest, F.lit("/"), F.lit(1))
    path = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


@dataclass
class Level:
    words: list[int]
    hashes: int
    seed: int

    @property
    def bits(self) -> int:
        return 64 * len(self.words)

    def knows(self, key: Column) -> Column:
        """All bits of the key are set."""
        table = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<long>")  # folded to one literal, however long
        out = F.lit(True)
        for at in positions(key, self.bits, self.hashes, self.seed):
            word = F.element_at(table, (F.shiftright(at, 6) + 1).cast("int"))
            out = out & (F.call_function("shiftrightunsigned", word, at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1)
        return out


def positions(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(bits).cast("long")) for i in range(hashes)]


def level(keys: DataFrame, bits: int, hashes: int, seed: int) -> Level:
    """Bloom filter of the column key, one row per 64-bit word that is not zero."""
    if bits > MAX_BITS:
        raise ValueError(f"a level of {bits} bits: shorten the list or raise MAX_BITS")
    at = keys.select(F.explode(F.array(*positions(F.col("key"), bits, hashes, seed))).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at").bitwiseAND(63).cast("int"))
    rows = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()  # at most bits / 64 rows
    words = [0] * (bits // 64)
    for r in rows:
        words[r["word"]] = r["bits"]
    return Level(words, hashes, seed)


class Cascade:
    """Exact membership in a list for the keys of a universe."""

    def __init__(self, universe: DataFrame):
        """universe: distinct `key` with a boolean `listed`, read once per level."""
        self.levels: list[Level] = []
        sizes = universe.agg(F.count_if("listed").alias("n"), F.count_if(~F.col("listed")).alias("rest")).first()
        wanted, n, rest = True, sizes["n"], sizes["rest"]
        left = universe
        while n:
            # as many halvings as make the false positives about as many as the keys, one bit more each level
            halvings = max(1, (rest // n).bit_length()) if not self.levels else 1
            bits = 64 * max(1, -(-int(n * LEVEL_BITS * halvings + 1) // 64))
            new = level(left.filter(F.col("listed") == wanted), bits, halvings, len(self.levels))
            self.levels.append(new)
            # keys on the other side that this level lets through, beside the side it was made of
            left = left.filter((F.col("listed") == wanted) | new.knows(F.col("key")))
            left = written(left) if len(self.levels) == 1 else left
            wanted = not wanted
            n, rest = left.filter(F.col("listed") == wanted).count(), n

    def holds(self, key: Column) -> Column:
        """Listed or not, for a key of the universe."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels) - 1, -1, -1):
            out = F.when(~self.levels[i].knows(key), F.lit(i % 2 == 1)).otherwise(out)
        return out


def keyed(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path and the candidate keys of every page.

    One candidate per shape of a rule: so many labels of the host's end, so many characters of the path's start.
    """
    labels = F.size(F.split("host", "\\.")).alias("labels")
    shapes = rules.select(labels, F.length("path").alias("chars")).distinct().orderBy("labels", "chars").collect()  # bounded by the rules
    host, path = parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    keys = [
        F.when((F.col("host") != "") & (F.length("path") >= s["chars"]), F.concat(F.substring_index("host", ".", -s["labels"]), F.substring("path", 1, s["chars"])))
        for s in shapes
    ]
    found = F.array_compact(F.array_distinct(F.array(*keys))) if keys else F.array().cast("array<string>")
    return rows.withColumn("keys", found)


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    rules: host, path (starting with a slash), verdict (block or allow).
    """
    listed = rules.select(F.concat("host", "path").alias("key"), (F.col("verdict") == "block").alias("block")).groupBy("key").agg(F.bool_or("block").alias("block"))
    rows = keyed(pages, rules)
    universe = written(
        rows.select(F.explode("keys").alias("key")).distinct()
        .join(listed, "key", "left").select("key", F.col("block").isNotNull().alias("listed"), F.coalesce("block", F.lit(False)).alias("block"))
    )
    known = Cascade(universe.select("key", "listed"))
    blocking = Cascade(universe.filter("listed").select("key", F.col("block").alias("listed")))
    fitting = F.filter("keys", known.holds)
    # longest rule first; of two equally long ones that of the longer host
    best = F.array_sort(F.transform(fitting, lambda k: F.struct(-F.length(k), F.instr(k, "/") * -1, k.alias("key"))))
    rule = F.try_element_at(best, F.lit(1))["key"]
    out = rows.select("page_id", "host", "path", rule.alias("rule"))
    return out.withColumn("verdict", F.when(F.col("rule").isNotNull() & blocking.holds(F.col("rule")), "block").otherwise("allow"))
