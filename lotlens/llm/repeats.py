"""Removal of long repeated byte strings through run-length indexes.

Every window of `length` bytes has an anchor, the position in it of the smallest gram hash;
windows in a row with one anchor make a piece. Equal windows have equal grams at their
anchors, at the same place, so repeats are found among the pieces of one anchor hash.
Pieces travel as numbers (where, anchor hash, digest); where all pieces of an
anchor are equal, they are repeats or there is one, and no text is needed. Of the rest one copy of each
distinct piece goes to a bucket by its anchor. A bucket's text is indexed as a run-compressed
Burrows-Wheeler transform with samples at the ends of its runs; matching
statistics (longest match with another place) are streamed from these samples, and windows matched in full
length are marked. Anchors with very many distinct pieces (a passage in a large part of all documents, with
different text around it) are not held in one task: blocks of their windows, then the windows of distinct blocks, are
counted by two independent 64-bit hashes.

Edges: a null text is an empty one; texts shorter than `length` lose nothing; repeated rows are repeats of each other and
a null doc_id is kept (rows equal in id and text are told apart only by their number); an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, written
from .words import mixed, powers

LENGTH = 200
GRAM = 24
#: Bytes of pieces in one index, about.
BUCKET_BYTES = 2_000_000
#: Distinct pieces of one anchor that go to one index at most.
CROWD = 2000
#: Windows of a block of a crowded anchor's piece.
BLOCK = 8
SLICE_BYTES = 2_000_000
BREAK = 0xFF  # no byte of UTF-8


def _table(seed: int) -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BASES = (np.uint64(0xD1342543DE82EF95), np.uint64(0xAF251AF3B0F025B5))
_TABLES = (_table(1), _table(2))


class Rolling:
    """Hashes of any stretch of the data from prefix sums; stretches of equal bytes have equal hashes."""

    def __init__(self, data: np.ndarray, which: int):
        base = _BASES[which]
        self.sums = np.r_[np.uint64(0), np.cumsum(_TABLES[which][data] * powers(base, len(data)), dtype=np.uint64)]
        self.shift = powers(np.uint64(pow(int(base), -1, 1 << 64)), len(data) + 1)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.shift[start] + (stop - start).astype(np.uint64))


def window_minimum(key: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of each window of that many."""
    out, have = key, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def cut_pieces(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text number, first window, windows, anchor hash, digest) of every piece of texts that fit one slice."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    ends = np.cumsum(sizes)
    first, second = Rolling(data, 0), Rolling(data, 1)
    at = np.arange(len(data) - gram + 1)
    grams = first.of(at, at + gram)
    low = np.uint64((1 << 24) - 1)  # a slice is shorter than 2**24: places fit below the hash
    best = window_minimum((grams & ~low) | at.astype(np.uint64), length - gram + 1) & low
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(best)]
    whole = np.flatnonzero(np.arange(len(best)) + length <= ends[owner])
    if not len(whole):
        return none, none, none, none, none
    anchor, owner = best[whole].astype(np.int64), owner[whole]
    cut = np.flatnonzero(np.r_[True, (np.diff(anchor) != 0) | (np.diff(owner) != 0)])
    n = np.diff(np.r_[cut, len(whole)])
    start, anchor, owner = whole[cut], anchor[cut], owner[cut]
    digest = mixed(second.of(start, start + n + length - 1) + (anchor - start).astype(np.uint64))
    return owner, start - (ends - sizes)[owner], n, grams[anchor].view(np.int64), digest.view(np.int64)


def _groups(raw: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    at, size = 0, 0
    for i, t in enumerate(raw):
        if i > at and size + len(t) > SLICE_BYTES:
            yield at, raw[at:i]
            at, size = i, 0
        size += len(t)
    if at < len(raw):
        yield at, raw[at:]


def _long_slices(text: bytes, length: int) -> Iterator[tuple[int, bytes]]:
    """A very long text in stretches that overlap by all but one byte of a window: every window is in one of them."""
    step = SLICE_BYTES
    if len(text) <= step + length:
        yield 0, text
        return
    for at in range(0, len(text) - length + 1, step):
        yield at, text[at:at + step + length - 1]


# -- the index -------------------------------------------------------------------

class RunIndex:
    """Run-compressed Burrows-Wheeler transform with samples at both ends of its runs.

    `heads` are text places of the suffixes that begin a run, with the length that each
    shares with the suffix before it in order; `tails` those that end a run, with the length
    shared with the one after. Inside a run both lengths follow from the place before: one less.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        order, levels = suffix_order(data)
        before = data[order - 1].astype(np.int16)
        before[order == 0] = -1  # the beginning of the text
        head = np.flatnonzero(np.r_[True, before[1:] != before[:-1]])
        tail = np.r_[head[1:], n] - 1
        self.runs, self.symbols = len(head), before[head]
        lower = np.where(head > 0, shared(data, levels, order[head], order[head - 1]), 0)
        upper = np.where(tail < n - 1, shared(data, levels, order[tail], order[np.minimum(tail + 1, n - 1)]), 0)
        self.heads, self.tails = (order[head], lower), (order[tail], upper)
        self.n = n

    def matching_statistics(self) -> np.ndarray:
        """For every place of the text the length of its longest match that starts at another place."""
        out = np.zeros(self.n, dtype=np.int64)
        at = np.arange(self.n)
        for places, values in (self.heads, self.tails):
            reach = np.zeros(self.n, dtype=np.int64)
            reach[places] = places + values
            # the end of the match never moves back, so the last sampled end holds until the next sample
            np.maximum(out, np.maximum.accumulate(reach) - at, out=out)
        return out


def suffix_order(data: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes in order, and the ranks by their first 8, 16, 32 ... bytes until all differ."""
    n = len(data)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    key = np.zeros(n, dtype=np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k:k + n]
    # zeros stand for the end: a text never holds a zero byte behind the last break, and ties end later anyhow
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]]
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0)).astype(np.int32)
    levels, h = [rank], 8
    while True:
        same = ~new
        open_ = same | np.r_[same[1:], False]  # in a group of several
        where = np.flatnonzero(open_)
        if not len(where):
            return order, levels
        todo = order[where]
        after = np.where(todo + h < n, rank[np.minimum(todo + h, n - 1)], -1).astype(np.int64)
        pair = (rank[todo].astype(np.int64) << 32) | (after + 1)
        sub = np.argsort(pair, kind="stable")
        order[where] = todo[sub]
        pair = pair[sub]
        fresh = np.r_[True, pair[1:] != pair[:-1]]
        new = new.copy()
        new[where] = fresh
        rank = rank.copy()
        rank[order[where]] = np.maximum.accumulate(np.where(fresh, where, 0)).astype(np.int32)
        h *= 2
        levels.append(rank)


def shared(data: np.ndarray, levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of the suffixes at a and b (two different ones each)."""
    n, out = len(data), np.zeros(len(a), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + out, b + out
        inside = (x < n) & (y < n)
        same = inside & (levels[k][np.minimum(x, n - 1)] == levels[k][np.minimum(y, n - 1)]) & (x != y)
        out += np.where(same, 8 << k, 0)
    for _ in range(8):
        x, y = a + out, b + out
        inside = (x < n) & (y < n)
        out += inside & (data[np.minimum(x, n - 1)] == data[np.minimum(y, n - 1)])
    return np.minimum(out, n - np.maximum(a, b))


def repeated_windows(pieces: list[bytes], windows: np.ndarray, length: int = LENGTH) -> list[np.ndarray]:
    """For each piece a flag per window: the window's text starts another window too."""
    stops = np.cumsum([len(p) + 1 for p in pieces])
    starts = np.r_[0, stops[:-1]]
    data = np.frombuffer(bytes([BREAK]).join(pieces) + bytes([BREAK]), dtype=np.uint8)
    matched = RunIndex(data).matching_statistics() >= length
    return [matched[s:s + n] for s, n in zip(starts.tolist(), windows.tolist())]


def runs_of(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, how many) of each stretch of set flags."""
    edge = np.diff(np.r_[0, flags.astype(np.int8), 0])
    first = np.flatnonzero(edge == 1)
    return list(zip(first.tolist(), (np.flatnonzero(edge == -1) - first).tolist()))


# -- crowded anchors -----------------------------------------------------------

def blocks_of(raw: bytes, n: int, anchor: int, length: int, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(first window, windows, two hashes) of the piece's blocks of BLOCK windows, counted from the anchor.

    Equal windows lie at the same place from their anchor, hence in blocks of the same number.
    """
    data = np.frombuffer(raw, dtype=np.uint8)
    first, second = Rolling(data, 0), Rolling(data, 1)
    at = np.arange(len(data) - gram + 1)
    place = int(np.argmax(first.of(at, at + gram).view(np.int64) == anchor))  # a window takes the leftmost gram of its anchor's hash
    window = np.arange(n)
    start = np.flatnonzero(np.r_[True, np.diff((window - place) // BLOCK) != 0])
    count = np.diff(np.r_[start, n])
    number = ((start - place).astype(np.int64)).view(np.uint64)
    return start, count, *(mixed(h.of(start, start + count + length - 1) + number).view(np.int64) for h in (first, second))


def _crowded_marks(pieces: DataFrame, length: int) -> DataFrame:
    """Repeated windows (anchor, digest, at, windows) of anchors with very many distinct pieces.

    Pieces fall into blocks; a block that occurs twice is repeated as a whole, and of each distinct block one
    copy is spelled out in windows, which are counted over all distinct blocks.
    """
    def cut(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a, d, c, n, raw in zip(f["anchor"], f["digest"], f["copies"], f["n"], f["bytes"]):
            start, count, one, two = blocks_of(raw, n, a, length)
            out.append(pd.DataFrame({"anchor": a, "digest": d, "at": start, "windows": count, "h1": one, "h2": two, "copies": c}))
        return pd.concat(out, ignore_index=True)

    blocks = written(map_rows(pieces, cut, "anchor long, digest long, at int, windows int, h1 long, h2 long, copies long"))
    distinct = written(blocks.groupBy("h1", "h2").agg(F.sum("copies").alias("seen"), F.min(F.struct("anchor", "digest", "at", "windows")).alias("first")))
    again = blocks.join(distinct.filter("seen > 1").select("h1", "h2"), ["h1", "h2"], "left_semi").select("anchor", "digest", "at", "windows")
    ones = distinct.select("first.*", "seen").groupBy("anchor", "digest").agg(F.collect_list(F.struct("at", "windows", "seen")).alias("cuts"))

    def spell(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for a, d, raw, cuts in zip(f["anchor"], f["digest"], f["bytes"], f["cuts"]):
            data = np.frombuffer(raw, dtype=np.uint8)
            at = np.concatenate([np.arange(c["at"], c["at"] + c["windows"]) for c in cuts])
            seen = np.concatenate([np.full(c["windows"], c["seen"]) for c in cuts])
            one, two = (Rolling(data, k).of(at, at + length).view(np.int64) for k in (0, 1))
            out.append(pd.DataFrame({"anchor": a, "digest": d, "at": at, "seen": seen, "h1": one, "h2": two}))
        return pd.concat(out, ignore_index=True)

    spelled = written(map_rows(pieces.join(ones, ["anchor", "digest"]).select("anchor", "digest", "bytes", "cuts"), spell, "anchor long, digest long, at int, seen long, h1 long, h2 long"))
    twice = spelled.groupBy("h1", "h2").agg(F.sum("seen").alias("n")).filter("n > 1").select("h1", "h2")
    single = spelled.filter("seen = 1").join(twice, ["h1", "h2"], "left_semi").select("anchor", "digest", "at", F.lit(1).alias("windows"))
    return again.unionByName(single)


# -- the job ---------------------------------------------------------------------

def remove(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    keyed = keyed.withColumn("id_key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    row = ["id_key", "text_key"]

    def cut(f: pd.DataFrame) -> pd.DataFrame:
        raw = [t.encode("utf-8", "surrogatepass") for t in f["text"]]
        ids, keys, out = f["id_key"].to_numpy(), f["text_key"].to_numpy(), []
        for at, group in _groups(raw):
            if len(group) == 1:
                parts = [(off, cut_pieces([part], length)) for off, part in _long_slices(group[0], length)]
            else:
                parts = [(0, cut_pieces(group, length))]
            for off, (owner, start, n, anchor, digest) in parts:
                out.append(pd.DataFrame({"id_key": ids[at + owner], "text_key": keys[at + owner], "start": start + off, "n": n, "anchor": anchor, "digest": digest}))
        return pd.concat(out, ignore_index=True)

    pieces = written(map_rows(keyed.select(*row, "text"), cut, "id_key long, text_key long, start int, n int, anchor long, digest long"))
    often = written(pieces.groupBy("anchor").count().filter("count > 1").select("anchor"))
    open_ = written(pieces.join(often, "anchor", "left_semi"))
    kinds = written(open_.groupBy("anchor", "digest").agg(F.count("*").alias("copies"), F.min(F.struct("id_key", "text_key", "start", "n")).alias("first")))
    anchors = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"))
    told = written(kinds.join(anchors.filter("kinds > 1"), "anchor").select("anchor", "digest", "copies", "kinds", "first.*"))

    # one copy of the text of each distinct piece of an anchor that has several
    wanted = told.groupBy(*row).agg(F.collect_list(F.struct("anchor", "digest", "start", "n", "copies", "kinds")).alias("cuts"))

    def copy(f: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for t, cuts in zip(f["text"], f["cuts"]):
            raw = t.encode("utf-8", "surrogatepass")
            rows += [(c["anchor"], c["digest"], c["copies"], c["kinds"], c["n"], raw[c["start"]:c["start"] + c["n"] + length - 1]) for c in cuts]
        return pd.DataFrame(rows, columns=["anchor", "digest", "copies", "kinds", "n", "bytes"])

    sources = keyed.join(wanted, row).select("text", "cuts")
    copied = written(map_rows(sources, copy, "anchor long, digest long, copies long, kinds long, n int, bytes binary"))
    size = copied.filter(F.col("kinds") <= CROWD).agg(F.sum(F.length("bytes"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    def index(f: pd.DataFrame) -> pd.DataFrame:
        f = f.drop_duplicates(["anchor", "digest"]).reset_index(drop=True)
        flags = repeated_windows(f["bytes"].tolist(), f["n"].to_numpy(), length)
        rows = []
        for a, d, c, n, own in zip(f["anchor"], f["digest"], f["copies"], f["n"], flags):
            rows += [(a, d, s, k) for s, k in ([(0, n)] if c > 1 else runs_of(own))]
        return pd.DataFrame(rows, columns=["anchor", "digest", "at", "windows"])

    found_schema = "anchor long, digest long, at int, windows int"
    indexed = (
        copied.filter(F.col("kinds") <= CROWD).withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        .groupBy("bucket").applyInPandas(index, found_schema)
    )

    crowded = _crowded_marks(copied.filter(F.col("kinds") > CROWD).dropDuplicates(["anchor", "digest"]), length)
    marks = written(indexed.unionByName(crowded))

    mixed_rows = open_.join(marks, ["anchor", "digest"]).select(*row, (F.col("start") + F.col("at")).alias("start"), "windows")
    alike = anchors.filter("kinds = 1").select("anchor")
    plain_rows = open_.join(alike, "anchor", "left_semi").select(*row, "start", F.col("n").alias("windows"))
    spans = mixed_rows.unionByName(plain_rows).groupBy(*row).agg(F.collect_set(F.struct("start", "windows")).alias("spans"))

    def finish(f: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for t, found in zip(f["text"], f["spans"]):
            raw = t.encode("utf-8", "surrogatepass")
            joined: list[list[int]] = []
            for s, e in sorted((x["start"], x["start"] + x["windows"] + length - 1) for x in (found if found is not None else ())):
                if joined and s <= joined[-1][1]:
                    joined[-1][1] = max(joined[-1][1], e)
                else:
                    joined.append([s, e])
            digest, last = hashlib.sha256(), 0
            for s, e in joined:
                digest.update(raw[last:s])
                last = e
            digest.update(raw[last:])
            rows.append((len(raw), sum(e - s for s, e in joined), len(joined), digest.hexdigest()))
        out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
        out.insert(0, "doc_id", f["doc_id"])
        return out

    whole = keyed.join(spans, row, "left").select("doc_id", "text", "spans")
    return map_rows(whole, finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
