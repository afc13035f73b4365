"""Quality rules with the frequency of lines across the documents of a host.

Every line is normalised (A-Z lower-cased, runs of digits as one 0, words joined by one blank) and hashed to 64 bits.
Per host the distinct documents of each line are counted. A line in more documents than the host's limit is removed
from all of them; a document of which too little is left is rejected, as is one that fails the base rules on its words.

One pass over the texts makes a row of statistics and line hashes per document; only these are shuffled: once to bring
repeated rows together, once as counts (added up before the shuffle, so a line of a third of all documents is one row
per task). Lines above the limit are at most (lines of the host) / (limit); Spark broadcasts them when their written
size allows and joins them otherwise, splitting a crowded key.

Edges: a null text is an empty one (no words, so it fails the base rules); a null host is a host of its own; a line
without words is never counted; rows equal in id, host and text are one document for the counts and come back as often
as they were given; other rows of one id are documents of their own; an empty table gives an empty result; further
columns are ignored, whatever their names. Within a host two lines of one 64-bit hash count as one line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import written

#: A line is too frequent in a host when it is in more documents than both of these.
MIN_DOCS, MAX_SHARE = 20, 0.01
#: A document is depleted when fewer than this share of its words is left.
LEAST_LEFT = 0.3
MIN_WORDS, MAX_REPEATED = 50, 0.5
WINDOW = 3

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLANKS = b" \t\n\v\f\r"
_DIGITS = re.compile(rb"[0-9]+")
_SYMBOLS = b"#*$%&|<>"
_TYPES = (
    "key binary, doc_id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " lines array<struct<hash:bigint,words:int,places:int>>"
)


def line_key(words: list[bytes]) -> int:
    """Signed 64-bit hash of a normalised line."""
    return xxhash.xxh64_intdigest(_DIGITS.sub(b"0", b" ".join(words).translate(_LOWER))) - (1 << 63)


def repeated_words(codes: np.ndarray, n: int = WINDOW) -> int:
    """Words in windows of n words that occur twice or more; codes number the words of one text."""
    m = len(codes) - n + 1
    if m < 2:
        return 0
    window = codes[:m].astype(np.int64)
    for k in range(1, n):
        # at most m + n distinct numbers before each step, so the product stays far below 64 bits
        window = np.unique(window * (int(codes.max()) + 1) + codes[k:k + m], return_inverse=True)[1]
    twice = np.bincount(window)[window] > 1
    marked = np.zeros(len(codes), dtype=bool)
    for k in range(n):
        marked[k:k + m] |= twice
    return int(marked.sum())


def _measure(text: str | None) -> tuple[int, int, int, int, int, list[dict[str, int]]]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    seen: set[bytes] = set()
    again = 0
    lines: dict[int, list[int]] = {}
    for line in raw.split(b"\n"):
        inside = line.split()
        if not inside:
            continue
        again += line in seen
        seen.add(line)
        at = lines.setdefault(line_key(inside), [0, 0])
        at[0] += len(inside)
        at[1] += 1
    chars = len(text or "") - sum(map(raw.count, (_BLANKS[i:i + 1] for i in range(len(_BLANKS)))))
    symbols = len(raw) - len(raw.translate(None, _SYMBOLS))
    codes = pd.factorize(np.array(words, dtype=object))[0] if len(words) > WINDOW else np.zeros(0, np.int64)
    return len(words), chars, symbols, again, repeated_words(codes), [{"hash": h, "words": w, "places": p} for h, (w, p) in lines.items()]


def measured(docs: DataFrame, host: Column) -> DataFrame:
    """key, doc_id, host, counts and the distinct lines of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"), F.col("text"))
    arrow = to_arrow_schema(T._parse_datatype_string(_TYPES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in arrow]
            for doc_id, at, text in zip(*(c.to_pylist() for c in batch.columns)):
                raw = (text or "").encode("utf-8", "surrogatepass")
                key = xxhash.xxh3_128_digest(repr((doc_id, at, len(raw))).encode("utf-8", "surrogatepass") + raw)
                for column, value in zip(out, (key, doc_id, at, *_measure(text))):
                    column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(out, arrow)], schema=arrow)

    return rows.mapInArrow(run, _TYPES)


def documents(docs: DataFrame, host: Column) -> DataFrame:
    """Written table: one row per distinct document, `times` telling how many equal rows there are."""
    rows = measured(docs, host)
    rest = F.struct(*[c for c in rows.columns if c != "key"])
    one = rows.groupBy("key").agg(F.first(rest).alias("r"), F.count(F.lit(1)).alias("times"))
    return written(one.select("key", "r.*", "times"))


def frequent_lines(found: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Written table (host, hash, docs, host_docs) of the lines in more than min_docs documents and max_share of the host's."""
    lines = found.select("host", F.explode("lines.hash").alias("hash")).groupBy("host", "hash").agg(F.count(F.lit(1)).alias("docs"))
    sizes = found.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    many = lines.filter(F.col("docs") > min_docs).alias("l").join(sizes.alias("s"), F.expr("l.host <=> s.host"))
    return written(many.filter(F.col("docs") > max_share * F.col("host_docs")).select("l.host", "hash", "docs", "host_docs"))


def judged(found: DataFrame, frequent: DataFrame, least_left: float = LEAST_LEFT) -> DataFrame:
    """The documents with the words removed, whether the base rules fail, and the verdict."""
    lines = found.select("key", "host", F.inline("lines"))
    hits = lines.alias("l").join(frequent.alias("f"), F.expr("l.host <=> f.host AND l.hash = f.hash"))
    gone = hits.groupBy("key").agg(F.sum("words").alias("n_removed_words"), F.sum("places").alias("n_removed_lines"), F.collect_set("l.hash").alias("removed"))
    out = found.drop("lines").join(gone, "key", "left").withColumns({
        "n_removed_words": F.coalesce("n_removed_words", F.lit(0)).cast("long"),
        "n_removed_lines": F.coalesce("n_removed_lines", F.lit(0)).cast("long"),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MAX_REPEATED) * F.col("n_words")),
    })
    left = F.col("n_words") - F.col("n_removed_words")
    return out.withColumn("kept", ~F.col("base_failed") & (left >= least_left * F.col("n_words")))


def judge(
    docs: DataFrame, host: Column | None = None, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, least_left: float = LEAST_LEFT
) -> DataFrame:
    """One row per row of docs: doc_id, the counts, what was removed, base_failed, kept."""
    found = documents(docs, F.col("source") if host is None else host)
    out = judged(found, frequent_lines(found, min_docs, max_share), least_left)
    each = out.select("*", F.explode(F.sequence(F.lit(1), "times")).alias("_copy"))
    return each.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "n_removed_lines", "base_failed", "kept")


def without_lines(text: str | None, removed: set[int]) -> str | None:
    """The text less the lines of these hashes; other lines stay as they are."""
    if not removed or text is None:
        return text
    raw = text.encode("utf-8", "surrogatepass").split(b"\n")
    return b"\n".join(x for x in raw if not (w := x.split()) or line_key(w) not in removed).decode("utf-8", "surrogatepass")


def keep_clean(
    docs: DataFrame, host: Column | None = None, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, least_left: float = LEAST_LEFT
) -> DataFrame:
    """doc_id, host and text, less its too frequent lines, of every document that is kept; equal rows as often as given."""
    host = F.col("source") if host is None else host
    found = documents(docs, host)
    kept = judged(found, frequent_lines(found, min_docs, max_share), least_left).filter("kept").select("key", "removed")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.cast("string").alias("host"), F.col("text"))
    schema = T._parse_datatype_string("key binary, doc_id long, host string, text string")
    arrow = to_arrow_schema(schema)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = []
            for doc_id, at, text in zip(*(c.to_pylist() for c in b.columns)):
                raw = (text or "").encode("utf-8", "surrogatepass")
                keys.append(xxhash.xxh3_128_digest(repr((doc_id, at, len(raw))).encode("utf-8", "surrogatepass") + raw))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(c.cast(f.type) for c, f in zip(b.columns, list(arrow)[1:]))], schema=arrow)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [without_lines(t, set(r or ())) for t, r in zip(b.column("text").to_pylist(), b.column("removed").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("host"), pa.array(texts, pa.string())], names=["doc_id", "host", "text"])

    return rows.mapInArrow(keyed, schema).join(kept, "key").select("doc_id", "host", "text", "removed").mapInArrow(cut, "doc_id long, host string, text string")
