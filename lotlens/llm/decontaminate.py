"""Benchmark items inside documents by size-partitioned MinHash containment search.

An item is the set of its word shingles (five words; an item of fewer words is one shingle
of all its words). Items are partitioned by the number of their shingles. The
sketch of an item is the smallest of its shingle hashes (a bottom-k MinHash), k set by
the partition's largest size u as floor((1 - t) u) + 1: a document that holds
a share t or more of the item's shingles lacks at most floor((1 - t) u) of them, so
it holds at least one of the sketch, whatever its own length. No candidate is missed.
Candidates are verified by exact containment over the shingles' words.

The items go to the tasks in blocks of bounded size (BLOCK_ITEMS, BLOCK_CHARS), one pass over the
documents per block; documents are never shuffled, so a frequent passage or hot source is
spread as the table is.

Edges: null and empty texts hold nothing; items without words are found nowhere;
repeated items are found each under its item_id; repeated documents each give their
rows; null ids are kept; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_rows, map_rows, text_rows
from .words import shingles, slices, word_hashes

WORDS = 5
CONTAINMENT = 0.8
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 16_000_000

#: A word: ASCII letters and digits and all characters outside ASCII; A-Z in lower case.
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
_LOW = {c: c + 32 for c in range(65, 91)}


def words_of(text: str) -> list[str]:
    return WORD.findall(text.translate(_LOW))


def shingle_set(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}


class ItemIndex:
    """Sketches of a block of items, by shingle length and size partition."""

    def __init__(self, items: list[tuple[object, str]], containment: float = CONTAINMENT, n: int = WORDS):
        self.containment, self.items, self.sets, self.width = containment, [], [], []
        by_width: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
        for item_id, text in items:
            words = words_of(text)
            width = min(n, len(words))
            if not width:
                continue
            hashes = np.unique(shingles(*word_hashes([text]), width)[0])
            by_width[width].append((len(self.items), hashes))
            self.items.append(item_id)
            self.sets.append(shingle_set(words, width))
            self.width.append(width)
        self.tables = {}
        for width, members in by_width.items():
            parts: dict[int, list[tuple[int, np.ndarray]]] = defaultdict(list)
            for at, hashes in members:
                parts[len(hashes).bit_length()].append((at, hashes))
            keys, values = [], []
            for part in parts.values():
                largest = max(len(h) for _, h in part)
                k = int((1 - containment) * largest + 1e-9) + 1
                for at, hashes in part:
                    sketch = hashes[:k]  # np.unique sorts: the k smallest
                    keys.append(sketch)
                    values.append(np.full(len(sketch), at))
            key, value = np.concatenate(keys), np.concatenate(values)
            order = np.argsort(key, kind="stable")
            self.tables[width] = (key[order], value[order])

    def search(self, texts: list[str]) -> Iterator[tuple[int, int, float]]:
        """(text number, item number, containment) of every item held to the asked share or more."""
        words, owner = word_hashes(texts)
        pairs: set[tuple[int, int]] = set()
        for width, (key, value) in self.tables.items():
            h, doc = shingles(words, owner, width)
            lo = np.searchsorted(key, h, side="left")
            hit = np.flatnonzero(key[np.minimum(lo, len(key) - 1)] == h)
            hi = np.searchsorted(key, h[hit], side="right")
            for a, b, d in zip(lo[hit].tolist(), hi.tolist(), doc[hit].tolist()):
                pairs.update((d, v) for v in value[a:b].tolist())
        held, last = {}, -1
        for d, at in sorted(pairs):
            if d != last:
                own, held, last = words_of(texts[d]), {}, d
            width = self.width[at]
            if width not in held:
                held[width] = shingle_set(own, width)
            share = len(self.sets[at] & held[width]) / len(self.sets[at])
            if share >= self.containment - 1e-12:
                yield d, at, share


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks of bounded size, one partition at a time on the driver."""
    block: list[tuple[object, str]] = []
    chars = 0
    for r in benchmark.select("item_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).toLocalIterator():
        if block and (len(block) >= BLOCK_ITEMS or chars + len(r["text"]) > BLOCK_CHARS):
            yield block
            block, chars = [], 0
        block.append((r["item_id"], r["text"]))
        chars += len(r["text"])
    if block:
        yield block


def contained(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, containment of every document that holds an item."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, containment double"
    out = spark.createDataFrame([], schema)
    for block in blocks(benchmark):
        index = spark.sparkContext.broadcast(ItemIndex(block, containment))  # BLOCK_ITEMS and BLOCK_CHARS bound it

        def run(f: pd.DataFrame, index=index) -> pd.DataFrame:
            ids, rows = f["doc_id"].tolist(), []
            for at, texts in slices(f["text"].tolist()):
                rows += [(ids[at + d], index.value.items[i], share) for d, i, share in index.value.search(texts)]
            return pd.DataFrame(rows, columns=["doc_id", "item_id", "containment"])

        out = out.unionByName(map_rows(text_rows(docs), run, schema))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The rows of docs, all columns as they are, that hold no item."""
    at = docs.columns.index("text")
    for block in blocks(benchmark):
        index = docs.sparkSession.sparkContext.broadcast(ItemIndex(block, containment))

        def clean(batch: pa.RecordBatch, index=index) -> np.ndarray:
            keep = np.ones(batch.num_rows, dtype=bool)
            for start, texts in slices([t or "" for t in batch.column(at).to_pylist()]):
                keep[[start + d for d, _, _ in index.value.search(texts)]] = False
            return keep

        docs = filter_rows(docs, clean)
    return docs
