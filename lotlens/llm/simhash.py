"""Near duplicates by SimHash fingerprints and a Gray-order hierarchical index.

Contract of the edges: a null text is an empty one; a text without words has
fingerprint zero and links like any other; rows with equal fingerprints (copies,
repeated rows, equal ids) are one node of the graph and all get its component;
a null doc_id keeps its row and is never the name of a component unless every
member is null; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, star_roots, text_rows, written

SEED = 42
#: A group of more fingerprints than this is dealt again by further bits.
GROUP_ROWS = 4096
FANOUT = 8


# -- fingerprints --------------------------------------------------------------

def fingerprint(text: str, words: int = 3) -> int:
    """SimHash of the word shingles, repeats included; a bit is set if set in over half of the hashes."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()  # bytes.lower and bytes.split know ASCII only
    n = len(parts)
    if not n:
        return 0
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    joined, m = b" ".join(parts), max(1, n - words + 1)
    starts = [0, *(ends[: m - 1] + 1).tolist()]
    stops = ends[n - m:].tolist()
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), dtype=np.uint64, count=m)
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, m, 8192):
        votes += np.unpackbits(h[at:at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > m, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fp (64 bits as a signed long) of every row."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        fp = np.array([fingerprint(t, words) for t in f["text"]], dtype=np.uint64).view(np.int64)
        return pd.DataFrame({"doc_id": f["doc_id"], "fp": fp})

    return map_rows(text_rows(docs), run, "doc_id long, fp long")


# -- the index -----------------------------------------------------------------

def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of each fingerprint in the reflected Gray order."""
    r = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """Fingerprints in Gray order, grouped level by level.

    A node keeps the bits on which all fingerprints below it agree, less those its
    parent already keeps: the differences a query collects on the way down are
    those of disjoint masks, so their sum is a lower bound at every node and the
    exact distance at a leaf.
    """

    def __init__(self, fp: np.ndarray, fanout: int = FANOUT):
        self.order = np.argsort(gray_rank(fp), kind="stable")
        self.fanout = fanout
        level = fp[self.order]
        ones, zeros = level, ~level  # bits set in all, bits clear in all
        levels = [(ones, ones | zeros)]
        while len(ones) > 1:
            cut = np.arange(0, len(ones), fanout)
            ones, zeros = np.bitwise_and.reduceat(ones, cut), np.bitwise_and.reduceat(zeros, cut)
            levels.append((ones, ones | zeros))
        self.levels = []
        for depth, (pattern, mask) in enumerate(levels):
            own = mask.copy()
            if depth + 1 < len(levels):
                own &= ~np.repeat(levels[depth + 1][1], fanout)[: len(mask)]
            self.levels.append((pattern, own))

    def within(self, queries: np.ndarray, distance: int, block: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions (query, member) of all pairs within the distance, block of queries by block."""
        for at in range(0, len(queries), block):
            q = queries[at:at + block]
            top = len(self.levels) - 1
            who = np.repeat(np.arange(len(q)), len(self.levels[top][0]))
            node = np.tile(np.arange(len(self.levels[top][0])), len(q))
            far = np.zeros(len(who), dtype=np.uint8)
            for depth in range(top, -1, -1):
                pattern, own = self.levels[depth]
                far = far + np.bitwise_count((q[who] ^ pattern[node]) & own[node])
                keep = far <= distance
                who, node, far = who[keep], node[keep], far[keep]
                if depth:
                    below = len(self.levels[depth - 1][0])
                    child = (node[:, None] * self.fanout + np.arange(self.fanout)).ravel()
                    who, far = np.repeat(who, self.fanout), np.repeat(far, self.fanout)
                    real = child < below
                    who, node, far = who[real], child[real], far[real]
            yield who + at, self.order[node]


def forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, smallest of its component) among distinct fingerprints within the distance."""
    root = np.arange(len(fp))

    def find(x: np.ndarray) -> np.ndarray:
        while True:
            up = root[x]
            if (up == x).all():
                return x
            x = up

    for a, b in GrayIndex(fp).within(fp, distance):
        off = a < b
        a, b = a[off], b[off]
        while len(a):
            ra, rb = find(a), find(b)
            lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
            open_ = lo < hi
            a, b, lo, hi = a[open_], b[open_], lo[open_], hi[open_]
            np.minimum.at(root, hi, lo)
    top = find(np.arange(len(fp)))
    linked = top != np.arange(len(fp))
    return fp[linked], fp[top[linked]]


def _keyed(fps: DataFrame, bits: list[tuple[int, int]], kept: int, *prefix: str) -> DataFrame:
    """A row per choice of `kept` blocks of bits, with the blocks' values as key."""
    keys = []
    for i, chosen in enumerate(combinations(bits, kept)):
        parts = [F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)) for lo, hi in chosen]
        keys.append(F.struct(F.lit(i).alias("i"), *[p.alias(f"v{k}") for k, p in enumerate(parts)]))
    return fps.select("fp", *prefix, F.explode(F.array(*keys)).alias("_k")).select("fp", *prefix, F.xxhash64(*prefix, "_k").alias("key"))


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """Edges (a, b) that connect all distinct fingerprints (column fp) within the distance.

    Two 64-bit fingerprints within d bits agree on d of 2d blocks of bits at least,
    so each goes to one group for every choice of d blocks, and each group's index finds its
    pairs. A group of more than GROUP_ROWS is dealt again, by blocks of the bits
    that it has left; what then stays together agrees on three quarters of the bits, of
    which there are 2**16 fingerprints at most (for a distance of 2). A group gives
    a spanning forest of its links, never all its pairs.
    """
    d = distance
    width = [round(i * 64 / (2 * d)) for i in range(2 * d + 1)]
    blocks = list(zip(width, width[1:]))
    first = written(_keyed(fps, blocks, d))
    big = written(first.groupBy("key").count().filter(F.col("count") > GROUP_ROWS).select("key"))
    small = first.join(big, "key", "left_anti")
    crowded = first.join(big, "key", "left_semi").withColumnRenamed("key", "outer")
    again = _split_again(crowded, blocks, d)
    groups = small.unionByName(again)
    parts = max(64, int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        n = 0
        for batch in batches:  # rows come sorted by key: whole groups are searched together, a bounded number of rows at a time
            held.append(batch)
            n += len(batch)
            if n >= 65536:
                frame = pd.concat(held, ignore_index=True)
                last = frame["key"].iloc[-1]
                done = frame["key"] != last
                if done.any():
                    yield _search(frame[done], d)
                    held = [frame[~done]]
                    n = len(held[0])
        if held:
            yield _search(pd.concat(held, ignore_index=True), d)

    return groups.repartition(parts, "key").sortWithinPartitions("key").mapInPandas(run, "a long, b long")


def _split_again(crowded: DataFrame, blocks: list[tuple[int, int]], d: int) -> DataFrame:
    """Deal crowded groups by the blocks they have not agreed on, each halved.

    The outer choice is one of the combinations of blocks; its complement has d
    blocks, cut into 2d halves, of which a pair within d bits agrees on d.
    """
    outs = []
    for chosen in combinations(blocks, d):
        rest = [b for b in blocks if b not in chosen]
        halves = [h for a, b in rest for h in ((a, (a + b) // 2), ((a + b) // 2, b))]
        own = F.xxhash64(F.struct(
            F.lit(list(combinations(blocks, d)).index(chosen)).alias("i"),
            *[F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias(f"v{k}") for k, (lo, hi) in enumerate(chosen)],
        ))
        outs.append(_keyed(crowded.filter(F.col("outer") == own), halves, d, "outer").drop("outer"))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


def _search(frame: pd.DataFrame, d: int) -> pd.DataFrame:
    keys = frame["key"].to_numpy()
    fp = frame["fp"].to_numpy().view(np.uint64)
    cut = np.flatnonzero(np.diff(keys)) + 1
    starts, stops = np.r_[0, cut], np.r_[cut, len(keys)]
    sizes = stops - starts
    a_out, b_out = [], []
    # groups of two to eight: all their pairs at once, in one array per size
    for size in range(2, 9):
        at = starts[sizes == size]
        if len(at):
            g = fp[at[:, None] + np.arange(size)]
            for i, j in combinations(range(size), 2):
                near = np.bitwise_count(g[:, i] ^ g[:, j]) <= d
                a_out.append(g[near, i])
                b_out.append(g[near, j])
    for s, e in zip(starts[sizes > 8], stops[sizes > 8]):
        a, b = forest(np.unique(fp[s:e]), d)
        a_out.append(a)
        b_out.append(b)
    if not a_out:
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
    return pd.DataFrame({"a": np.concatenate(a_out).view(np.int64), "b": np.concatenate(b_out).view(np.int64)})


def components(docs: DataFrame, words: int = 3, distance: int = 2) -> DataFrame:
    """doc_id, fp, component_id of every row; a component is named by its smallest doc_id."""
    rows = written(fingerprints(docs, words))
    nodes = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = star_roots(links(nodes.select("fp"), distance)).withColumnRenamed("node", "fp")
    named = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = written(named.join(names, "root").select("fp", "component_id"))
    return rows.join(by_fp, "fp").select("doc_id", "fp", "component_id")
