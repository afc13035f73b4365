"""Phrase collocations by the stripes pattern.

Within a piece of text every prefix of 0 to max_words - 1 words keys an associative counter of the words that follow
it: a stripe. A stripe's entries are the counts of the prefix's extensions, the total of a prefix is its entry in the
stripe of the prefix one word shorter, and the largest entry of a stripe is the strongest longer phrase that begins
with the prefix (the strongest that ends with it is the largest over the stripes of the words before). Scores and
subsumption need nothing else.

Tasks build stripes of a few million words in memory and send them in segments: an entry's bucket is the hash of prefix
and next word, so the stripe of a very frequent prefix is spread over all buckets and no group holds a whole one. A row
carries the words once and short numbers for the rest. Buckets grow in number with the text, each merges its segments
elementwise, exactly, on the words themselves. Only entries of the least count leave a bucket: a cut of a candidate is
at least as frequent as the candidate, so no count that a score needs is missing.

Edges: a null text is an empty one, a null lang is `und`; repeated rows count each; texts without words add nothing; a
lang without candidates has no rows; an empty table gives an empty result; further columns are ignored. Counts are
exact 64-bit numbers, products are made in 38 decimal digits (enough for counts below 10**15).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import written
from .words import mixed

MIN_COUNT, MAX_WORDS, TOP = 10, 3, 2000
#: Words that a task gathers before it sends its stripes, and bytes of text per bucket.
FLUSH_WORDS, BUCKET_BYTES = 1_500_000, 8_000_000
#: Entries that a bucket gathers before it merges them.
MERGE_ROWS = 1_000_000
#: Characters of text that a task turns into words at a time.
SLICE_CHARS = 500_000

_END = b"\xff"  # no byte of UTF-8
_TABLE = bytes(0xFF if c in b".,;:!?\n\v\f\r" else 0x20 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))
_SEGMENT = "lang string, bucket int, depth int, stripes int, entries int, words binary, prefix binary, size binary, next binary, count binary"
_ENTRY = "lang string, phrase array<string>, f long"


def packed(x: np.ndarray) -> bytes:
    """Whole numbers from 0 in as few bytes each as the largest needs: 1, 2, 4 or 8."""
    return x.astype(np.min_scalar_type(int(x.max(initial=0)))).tobytes()


def unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"u{max(1, len(raw) // max(1, n))}")


def tokens(text: str) -> list[bytes]:
    """Words in lower case (A-Z only), with an end mark between pieces."""
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).replace(_END, b" \xff ").split(b" ")


class Stripes:
    """Stripes of one lang: words are numbered as they come, the end mark is 0."""

    def __init__(self) -> None:
        self.number: dict[bytes, int] = {_END: 0}
        self.parts: list[np.ndarray] = []
        self.words = 0

    def add(self, texts: list[str]) -> None:
        flat: list[bytes] = [_END]
        for t in texts:
            flat += tokens(t)
            flat.append(_END)
        coded = pa.array(flat, pa.binary()).dictionary_encode()
        seen = coded.dictionary.to_pylist()
        own = np.array([-1 if not w else self.number.setdefault(w, len(self.number)) for w in seen], dtype=np.int32)
        codes = own[coded.indices.to_numpy()]
        codes = codes[codes >= 0]  # blanks in a row leave empty words
        self.parts.append(codes)
        self.words += len(codes)

    def segments(self, depth: int, buckets: int) -> Iterator[tuple]:
        """Rows of every prefix length below depth: the words once, then per stripe its prefix and size, per entry the next word and count."""
        codes = np.concatenate([np.zeros(1, np.int32), *self.parts])
        names = np.array(list(self.number), dtype=object)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), dtype=np.uint64, count=len(names))
        base = np.int64(len(names))
        prefix = np.zeros(len(codes), dtype=np.int32)  # number of the prefix that ends before each place; -1: none
        known = np.zeros((1, 0), dtype=np.int32)  # the words of each prefix
        hashed = np.zeros(1, dtype=np.uint64)
        for k in range(depth):
            at = np.flatnonzero((prefix >= 0) & (codes > 0))
            if not len(at):
                return
            entry, inverse, count = np.unique(prefix[at] * base + codes[at], return_inverse=True, return_counts=True)
            before, after = entry // base, (entry % base).astype(np.int32)
            hashed = mixed(hashed[before] * np.uint64(0x9E3779B97F4A7C15) + hashes[after])
            bucket = (hashed % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=buckets))
            for lo, hi in zip(cuts, cuts[1:]):
                part = order[lo:hi]  # stripe by stripe, as entries are sorted
                head = np.flatnonzero(np.diff(before[part], prepend=-1))
                used, local = np.unique(np.concatenate([known[before[part[head]]].ravel(), after[part]]), return_inverse=True)
                firsts = len(head) * k
                yield (
                    int(bucket[part[0]]), k, len(head), len(part), b" ".join(names[used].tolist()),
                    packed(local[:firsts]), packed(np.diff(head, append=len(part))), packed(local[firsts:]), packed(count[part]))
            known = np.concatenate([known[before], after[:, None]], axis=1)
            prefix = np.full(len(codes), -1, dtype=np.int32)
            inside = at + 1 < len(codes)
            prefix[at[inside] + 1] = inverse[inside]


def _sent(depth: int, buckets: int):
    arrow = to_arrow_schema(T._parse_datatype_string(_SEGMENT))

    def row(lang: str, s: tuple) -> pa.RecordBatch:
        values = (lang, *s)
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Stripes] = {}
        for batch in batches:
            by: dict[str, list[str]] = {}
            size = 0
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                by.setdefault(batch.column("lang")[i].as_py(), []).append(text)
                size += len(text)
                if size > SLICE_CHARS or i + 1 == batch.num_rows:
                    for at, texts in by.items():
                        held.setdefault(at, Stripes()).add(texts)
                    by, size = {}, 0
                    while sum(s.words for s in held.values()) > FLUSH_WORDS:
                        at = max(held, key=lambda n: held[n].words)
                        for s in held.pop(at).segments(depth, buckets):
                            yield row(at, s)
        for at, stripes in held.items():
            for s in stripes.segments(depth, buckets):
                yield row(at, s)

    return run


class Merged:
    """Segments of one lang, bucket and prefix length, merged elementwise."""

    def __init__(self, depth: int) -> None:
        self.depth, self.number, self.rows, self.counts, self.waiting = depth, {}, [], [], 0

    def add(self, words: list[bytes], prefix: np.ndarray, size: np.ndarray, following: np.ndarray, count: np.ndarray) -> None:
        own = np.array([self.number.setdefault(w, len(self.number)) for w in words], dtype=np.int32)
        heads = np.repeat(own[prefix].reshape(len(size), self.depth), size, axis=0)
        self.rows.append(np.concatenate([heads, own[following][:, None]], axis=1))
        self.counts.append(count.astype(np.int64))
        self.waiting += len(count)
        if self.waiting > MERGE_ROWS:
            self.merge()

    def merge(self) -> None:
        rows, counts = np.concatenate(self.rows), np.concatenate(self.counts)
        key, bound = rows[:, 0].astype(np.int64), len(self.number)
        for k in range(1, rows.shape[1]):
            if bound * len(self.number) >= 2**62:  # numbered anew, so that the next step stays below 64 bits
                key = np.unique(key, return_inverse=True)[1]
                bound = len(key)
            key, bound = key * np.int64(len(self.number)) + rows[:, k], bound * len(self.number)
        order = np.argsort(key)
        first = np.flatnonzero(np.diff(key[order], prepend=-1))
        self.rows, self.counts, self.waiting = [rows[order[first]]], [np.add.reduceat(counts[order], first)], 0

    def entries(self, least: int) -> tuple[list[list[str]], list[int], int]:
        self.merge()
        names = list(self.number)
        keep = self.counts[0] >= least
        phrases = [[names[w].decode("utf-8", "surrogatepass") for w in r] for r in self.rows[0][keep].tolist()]
        return phrases, self.counts[0][keep].tolist(), int(self.counts[0].sum())


def _merge(least: int):
    arrow = to_arrow_schema(T._parse_datatype_string(_ENTRY))

    def out(key: tuple, m: Merged) -> pa.RecordBatch:
        phrases, counts, total = m.entries(least)
        if not key[2]:  # the words of the bucket, frequent or not: their sum over the buckets is n
            phrases.append([])
            counts.append(total)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * len(counts), pa.string()), pa.array(phrases, arrow.field("phrase").type), pa.array(counts, pa.int64())], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, merged = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                key = tuple(batch.column(c)[i].as_py() for c in ("lang", "bucket", "depth"))
                if key != now:
                    if now is not None:
                        yield out(now, merged)
                    now, merged = key, Merged(key[2])
                value = {c: batch.column(c)[i].as_py() for c in ("stripes", "entries", "words", "prefix", "size", "next", "count")}
                stripes, entries = value["stripes"], value["entries"]
                merged.add(
                    value["words"].split(b" "), unpacked(value["prefix"], stripes * key[2]), unpacked(value["size"], stripes),
                    unpacked(value["next"], entries), unpacked(value["count"], entries))
        if now is not None:
            yield out(now, merged)

    return run


def frequencies(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT) -> DataFrame:
    """Written table (lang, phrase as array, f): phrases of 1 to max_words words with f >= min_count; the empty phrase's f adds up to n."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    sent = rows.mapInArrow(_sent(max_words, 1 + size // BUCKET_BYTES), _SEGMENT)
    # a wide range of buckets per task; in order, so that a task holds one lang, bucket and length at a time
    dealt = sent.repartition("lang", "bucket", "depth").sortWithinPartitions("lang", "bucket", "depth")
    return written(dealt.mapInArrow(_merge(min_count), _ENTRY))


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of 2 to max_words words of each lang."""
    return scored(frequencies(docs, max_words, min_count), top)


def scored(counted: DataFrame, top: int = TOP) -> DataFrame:
    """The collocations of a table of frequencies."""
    totals = counted.filter(F.size("phrase") == 0).groupBy("lang").agg(F.sum("f").alias("n"))
    known = counted.filter(F.size("phrase") > 0)
    # the largest longer phrase: of this prefix's stripe, and of the stripes whose entry ends with the phrase
    ends = F.array(F.expr("slice(phrase, 1, size(phrase) - 1)"), F.expr("slice(phrase, 2, size(phrase) - 1)"))
    longer = known.filter(F.size("phrase") > 2).select("lang", F.explode(ends).alias("phrase"), "f")
    above = longer.groupBy("lang", "phrase").agg(F.max("f").alias("above"))
    found = known.filter(F.size("phrase") > 1).select("lang", "phrase", F.col("f").alias("a")).join(above, ["lang", "phrase"], "left")
    cuts = found.filter("above IS NULL OR 2 * above < a").select("lang", "phrase", "a", F.explode(F.expr("sequence(1, size(phrase) - 1)")).alias("k"))
    cuts = cuts.select("*", F.expr("slice(phrase, 1, k)").alias("head"), F.expr("slice(phrase, k + 1, size(phrase))").alias("tail"))
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    # a <= l and a <= r, so the quotient is at most 1000000; products in whole decimals
    d = lambda c: f"CAST({c} AS DECIMAL(15, 0))"
    score = F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * {d('a')} * {d('a')}) div ({d('l')} * {d('r')})")
    lowest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r")).alias("c"))
    best = lowest.select("lang", F.array_join("phrase", " ").alias("phrase"), "c.*")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    first = best.withColumn("rank", rank).filter(F.col("rank") <= top)
    return first.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
