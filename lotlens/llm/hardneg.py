"""Hard negatives by angular triangle filtering.

Vectors are whole numbers, floor(256 * x), and a score is their inner product. Every row stores its norm and its angles
to a few reference directions. For an anchor and a row the angles to one reference differ by at most the angle between
the two and add up to at least that, so each reference gives an interval of that angle; the intersection over the
references gives a cosine interval, and the norms make it an interval of the score, widened so that no rounding can
shut a score out. Rows whose interval overlaps nothing that is asked for are never scored:

* positives: an anchor's five best of its label reach at least the fifth largest lower bound in the shard;
* negatives: a score between 0.8 of a positive's score and that score, tested for groups of rows and then row by row.

The others are scored in whole numbers and kept by exact comparison, so the bounds decide the work and never the result.

Rows are dealt into shards of about SHARD_ROWS, in order of label, nearest reference and the angle to it, whatever label
or vector is frequent. A task holds one shard, and the anchors stream past it; all that leaves is `most` rows per anchor
(and positive) and shard. Every anchor meets every shard, so the work grows with anchors times rows.

Edges: rows with a null id, a null label, a null vector or any null or non-finite component take no part, neither do
vectors of another length than the most frequent one (the smaller on ties); zero vectors score 0; an anchor never pairs
with rows of its own id; repeated rows take part each for itself, also as anchors; a positive with a negative score has
no window; fewer rows than asked for are all returned; scores are limited to 64 bits; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import written

REFERENCES = 16
#: Reference directions are chosen among at most so many rows, those of the smallest id hashes.
FIT_ROWS = 2048
SHARD_ROWS = 8192
GROUP_ROWS = 64
ANCHOR_ROWS = 256  # anchors that a task compares at a time
SCALE = 256
_LIMIT = 2**63 - 1
_EXACT = 2.0**53  # whole numbers below are exact in double precision
_HUGE = 1e150  # rows of a larger norm are always scored

_ROW = "vec_id long, label long, v binary, norm double, angles binary, cell int, near double, anchor boolean"


def whole(v: np.ndarray) -> np.ndarray:
    """floor(256 * x) in double precision, exact up to overflow."""
    with np.errstate(over="ignore"):
        return np.floor(v * SCALE)


def slack(width: int) -> float:
    """More than an angle can be off: a cosine is a sum of `width` rounded products."""
    return 4 * float(np.sqrt(2 * (width + 8) * np.finfo(float).eps))


def directions(v: np.ndarray, most: int = REFERENCES) -> np.ndarray:
    """Unit vectors among the rows, each as far as can be from the lines of those before."""
    x = whole(v)
    with np.errstate(over="ignore"):
        size = np.sqrt((x * x).sum(axis=1))
    u = x[(size > 0) & (size < _HUGE)] / size[(size > 0) & (size < _HUGE)][:, None]
    if not len(u):
        return np.zeros((0, v.shape[1]))
    chosen, near = [u[0]], np.abs(u @ u[0])
    while len(chosen) < min(most, len(u)):
        chosen.append(u[int(np.argmin(near))])
        near = np.maximum(near, np.abs(u @ chosen[-1]))
    return np.stack(chosen)


def angles(v: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norm of each row in whole numbers and its angles to the references; no angles (0) where the norm is 0 or too large."""
    x = whole(v)
    with np.errstate(over="ignore", invalid="ignore"):
        size = np.sqrt((x * x).sum(axis=1))
        usual = (size > 0) & (size < _HUGE)
        cos = np.zeros((len(x), len(refs)))
        cos[usual] = (x[usual] @ refs.T) / size[usual][:, None]
    out = np.arccos(np.clip(cos, -1, 1))
    out[~usual] = 0
    return np.where(size < _HUGE, size, np.inf), out


def interval(size: np.ndarray, angle: np.ndarray, low_size: np.ndarray, high_size: np.ndarray, low: np.ndarray, high: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the scores of anchors (norm, angles) with rows or groups of rows (ranges of norms and of angles)."""
    shape = (len(size), len(low_size))
    apart, within = np.zeros(shape), np.full(shape, np.pi)
    for k in range(angle.shape[1]):
        a = angle[:, k, None]
        np.maximum(apart, np.maximum(a - high[None, :, k], low[None, :, k] - a), out=apart)
        # a + b or, over the opposite direction, 2 pi - (a + b)
        np.minimum(within, np.minimum(a + high[None, :, k], 2 * np.pi - a - low[None, :, k]), out=within)
    s = slack(width)
    most, least = np.cos(np.clip(apart - s, 0, np.pi)), np.cos(np.clip(within + s, 0, np.pi))
    with np.errstate(over="ignore", invalid="ignore"):
        small, large = size[:, None] * low_size[None, :], size[:, None] * high_size[None, :]
        room = 1 + 1e-9 * large
        upper = np.where(most > 0, large, small) * most + room
        lower = np.where(least > 0, small, large) * least - room
    known = np.isfinite(large)
    # scores are limited to 64 bits, so bounds beyond them come back inside
    return np.where(known, np.minimum(lower, 2.0**62), -np.inf), np.where(known, np.maximum(upper, -(2.0**62)), np.inf)


def products(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, limited to 64 bits; rows are the raw vectors."""
    p, q = whole(a), whole(x)
    with np.errstate(over="ignore"):
        top = np.abs(p).max(initial=0) * np.abs(q).max(initial=0) * p.shape[1]
    if top < _EXACT:
        return (p @ q.T).astype(np.int64)
    exact = lambda m: [[int(e) * SCALE if abs(e) >= _EXACT else int(np.floor(e * SCALE)) for e in r] for r in m.tolist()]
    rows, cols = exact(a), exact(x)
    out = [[max(-_LIMIT - 1, min(_LIMIT, sum(map(int.__mul__, r, c)))) for c in cols] for r in rows]
    return np.array(out, dtype=np.int64).reshape(len(rows), len(cols))


class Shard:
    """Rows of a shard with the ranges of groups of them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, v: np.ndarray, norms: np.ndarray, angle: np.ndarray):
        self.ids, self.labels, self.v, self.norms, self.angles = ids, labels, v, norms, angle
        cuts = np.arange(0, len(ids), GROUP_ROWS)
        self.group = np.arange(len(ids)) // GROUP_ROWS
        ends = (np.minimum.reduceat, np.maximum.reduceat)
        self.sizes = [f(norms, cuts) for f in ends]
        self.ranges = [f(angle, cuts, axis=0) for f in ends]

    def bounds(self, size: np.ndarray, angle: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return interval(size, angle, self.norms[at], self.norms[at], self.angles[at], self.angles[at], self.v.shape[1])

    def group_bounds(self, size: np.ndarray, angle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return interval(size, angle, *self.sizes, *self.ranges, self.v.shape[1])


def first_rows(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first `most`, by score descending, then id."""
    at = np.arange(len(scores))
    if len(scores) > most:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    return at[np.lexsort((ids[at], ~scores[at]))[:most]]  # ~x is -x - 1, which 64 bits hold for every x


def best_of_label(most: int) -> Callable:
    """Per anchor the first rows of its label: (row, 0, id, score)."""
    def look(s: Shard, a: Anchors) -> list[tuple]:
        out: list[tuple] = []
        for label in np.unique(a.labels):
            mine, at = np.flatnonzero(a.labels == label), np.flatnonzero(s.labels == label)
            if not len(at):
                continue
            lower, upper = s.bounds(a.norms[mine], a.angles[mine], at)
            other = a.ids[mine][:, None] != s.ids[at][None, :]
            lower = np.where(other, lower, -np.inf)
            reach = np.partition(lower, len(at) - most, axis=1)[:, len(at) - most] if len(at) > most else np.full(len(mine), -np.inf)
            asked = other & (upper >= reach[:, None])
            some = np.flatnonzero(asked.any(axis=0))
            if not len(some):
                continue
            scores = products(a.v[mine], s.v[at[some]])
            for i, j in enumerate(mine):
                here = np.flatnonzero(asked[i, some])
                own = scores[i, here]
                for k in first_rows(own, s.ids[at[some[here]]], most):
                    out.append((int(a.rows[j]), 0, int(s.ids[at[some[here[k]]]]), int(own[k])))
        return out

    return look


def in_windows(most: int) -> Callable:
    """Per anchor and window the first rows of other labels with a score inside: (row, window, id, score)."""
    def look(s: Shard, a: Anchors) -> list[tuple]:
        out: list[tuple] = []
        lows, highs = a.lows, a.highs  # anchors x windows; an empty window has low > high
        low, high = lows.min(axis=1)[:, None], highs.max(axis=1)[:, None]
        least, top = s.group_bounds(a.norms, a.angles)
        groups = ((top >= low) & (least <= high)).any(axis=0)
        at = np.flatnonzero(groups[s.group])
        if not len(at):
            return out
        lower, upper = s.bounds(a.norms, a.angles, at)
        other = a.labels[:, None] != s.labels[at][None, :]
        asked = np.zeros(other.shape, dtype=bool)
        for w in range(lows.shape[1]):
            asked |= (upper >= lows[:, w, None]) & (lower <= highs[:, w, None])
        asked &= other & (a.ids[:, None] != s.ids[at][None, :])
        some = np.flatnonzero(asked.any(axis=0))
        if not len(some):
            return out
        scores = products(a.v, s.v[at[some]])
        ids = s.ids[at[some]]
        for i in range(len(a.rows)):
            here = np.flatnonzero(asked[i, some] & (scores[i] >= low[i]) & (scores[i] <= high[i]))
            own, own_ids = scores[i, here], ids[here]
            for w in range(lows.shape[1]):
                inside = np.flatnonzero((own >= lows[i, w]) & (own <= highs[i, w]))
                for k in first_rows(own[inside], own_ids[inside], most):
                    out.append((int(a.rows[i]), w, int(own_ids[inside[k]]), int(own[inside[k]])))
        return out

    return look


class Anchors:
    def __init__(self, batch: pa.RecordBatch, width: int):
        self.rows, self.ids, self.labels, self.v, self.norms, self.angles = _columns(batch, width)
        for name in ("lows", "highs"):
            lists = batch.column(name).to_pylist()
            setattr(self, name, np.array(lists, dtype=np.int64) if lists[0] is not None else None)


def _columns(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    whole_ = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    matrix = lambda c, d: np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<f8").reshape(batch.num_rows, d)
    v = matrix("v", width)
    raw = batch.column("angles")[0].as_py() if batch.num_rows else b""
    return whole_("row"), whole_("vec_id"), whole_("label"), v, whole_("norm"), matrix("angles", len(raw) // 8)


def streamed(shards: DataFrame, anchors: DataFrame, width: int, look: Callable) -> DataFrame:
    """row, window, found_id, score of what `look` finds for every anchor in every shard."""
    count = (shards.agg(F.max("shard")).first()[0] or 0) + 1
    none = F.lit(None).cast("array<long>")
    held = shards.select("shard", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("row"), "vec_id", "label", "v", "norm", "angles", none.alias("lows"), none.alias("highs"))
    sent = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("shard"), F.lit(1).alias("kind"), "row", "vec_id", "label", "v", "norm", "angles", "lows", "highs")
    dealt = held.unionByName(sent).repartition(count, "shard").sortWithinPartitions("shard", "kind")
    schema = T._parse_datatype_string("row long, window int, found_id long, score long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, shard = None, [], None
        for batch in batches:
            mark = batch.column("shard").to_numpy().astype(np.int64) * 2 + batch.column("kind").to_numpy()
            cuts = np.r_[np.flatnonzero(np.diff(mark, prepend=-1)), len(mark)]
            for lo, hi in zip(cuts, cuts[1:]):
                part, kind = batch.slice(lo, hi - lo), int(mark[lo]) % 2
                if int(mark[lo]) // 2 != now:
                    now, parts, shard = int(mark[lo]) // 2, [], None
                if kind == 0:
                    parts.append(_columns(part, width)[1:])
                    continue
                if shard is None and parts:
                    shard = Shard(*(np.concatenate(c) for c in zip(*parts)))
                    parts = []
                for i in range(0, part.num_rows, ANCHOR_ROWS) if shard else ():
                    found = look(shard, Anchors(part.slice(i, ANCHOR_ROWS), width))
                    if found:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    return dealt.mapInArrow(run, schema)


def usable(v: Column) -> Column:
    return v.isNotNull() & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def measured(rows: DataFrame, refs: np.ndarray) -> DataFrame:
    """Rows (vec_id, label, v, anchor) with norm, angles, nearest reference and the angle to it."""
    arrow = to_arrow_schema(T._parse_datatype_string(_ROW))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v = np.ascontiguousarray(b.column("v").values.to_numpy(), dtype="<f8")[b.column("v").offsets[0].as_py():].reshape(b.num_rows, -1)
            size, at = angles(v, refs)
            cell = at.argmin(axis=1).astype(np.int32) if at.shape[1] else np.zeros(len(v), np.int32)
            near = at[np.arange(len(v)), cell] if at.shape[1] else np.zeros(len(v))
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id"), b.column("label"), pa.array([r.tobytes() for r in v], pa.binary()), pa.array(size),
                pa.array([r.tobytes() for r in at.astype("<f8")], pa.binary()), pa.array(cell), pa.array(near), b.column("anchor"),
            ], schema=arrow)

    return rows.mapInArrow(run, _ROW)


def mine(
    vectors: DataFrame, anchors: Column, label: Column | None = None, positives: int = 5, negatives: int = 5,
    references: int = REFERENCES, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; vectors: vec_id, label, embedding."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    width, count = (common["n"], common["count"]) if common else (0, 0)
    rows = rows.filter(F.size("v") == width)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("v").collect()  # FIT_ROWS vectors
    refs = directions(np.array([r["v"] for r in sample], dtype=np.float64).reshape(len(sample), width), references)
    stored = written(measured(rows, refs).withColumn("order", F.monotonically_increasing_id()))
    # the last key parts rows that are alike in all others
    ranged = stored.repartitionByRange(max(1, -(-count // shard_rows)), "label", "cell", "near", "vec_id", "order")
    ordered = ranged.sortWithinPartitions("label", "cell", "near", "vec_id").withColumn("shard", F.spark_partition_id())
    shards = written(ordered.select("shard", "vec_id", "label", "v", "norm", "angles"))
    none = F.lit(None).cast("array<long>")
    asked = stored.filter("anchor").select(F.col("order").alias("row"), "vec_id", "label", "v", "norm", "angles")

    best = streamed(shards, asked.withColumns({"lows": none, "highs": none}), width, best_of_label(positives))
    nth = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "found_id"))
    good = written(best.withColumn("nth", nth).filter(F.col("nth") <= positives).select("row", "nth", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")))

    # 80 p <= 100 n <= 100 p in whole numbers: n from p - p div 5 to p; from 0 to -1, so empty, where p < 0 or there is no such positive
    own = good.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("nth", "positive_score"))).alias("p"))
    highs = F.transform(F.sequence(F.lit(1), F.lit(positives)), lambda i: F.greatest(F.coalesce(F.try_element_at("p", i), F.lit(-1)), F.lit(-1).cast("long")))
    lows = F.transform("highs", lambda s: F.when(s < 0, F.lit(0).cast("long")).otherwise(s - F.call_function("div", s, F.lit(5))))
    windows = asked.join(own, "row").withColumn("highs", highs).withColumn("lows", lows).drop("p")
    hard = streamed(shards, written(windows), width, in_windows(negatives)).withColumn("nth", F.col("window") + 1)
    rank = F.row_number().over(Window.partitionBy("row", "nth").orderBy(F.desc("score"), "found_id"))
    ranked = hard.withColumn("rank", rank).filter(F.col("rank") <= negatives)
    named = stored.filter("anchor").select(F.col("order").alias("row"), F.col("vec_id").alias("anchor_id"))
    return ranked.join(good, ["row", "nth"]).join(named, "row").select(
        "anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
