"""Approximate nearest neighbours: a navigable small-world graph per shard.

Equal vectors are one node (with the smallest ids that a result can need: k + 1). Nodes are dealt to shards of
about SHARD_ROWS by a hash; each shard builds a hierarchical navigable small-world graph and
stores it as flat neighbour arrays in a written table. Queries go to every shard in blocks of bounded
size; the shards' nearest are merged. All rows are indexed, none is sampled.

Edges: vectors that are null, empty, zero or hold null or non-finite components take no part, neither do
vectors of another length than the most frequent one (the smaller on ties); a null id takes no part as a query; repeated rows are
candidates each for itself (a query leaves out one row of its own id); fewer candidates than k
are all returned; distances are in double precision (infinite where a square overflows); an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHARD_ROWS = 4096
BLOCK_ROWS = 4096
DEGREE = 14  # links of a node on upper levels; twice as many on the lowest
EF_BUILD = 64
EF_SEARCH = 128


class SmallWorld:
    """Hierarchical navigable small-world graph over the rows of a matrix."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, ef: int = EF_BUILD, seed: int = 7):
        self.v = np.ascontiguousarray(vectors, dtype=np.float64)
        n = len(self.v)
        height = np.floor(-np.log(1.0 - np.random.default_rng(seed).random(n)) / np.log(degree)).astype(int)
        self.degree, self.entry, self.top = degree, 0, int(height[0]) if n else 0
        self.links: list[dict[int, list[int]]] = [{} for _ in range(int(height.max(initial=0)) + 1)]
        self.squares = np.einsum("ij,ij->i", self.v, self.v)
        self.seen = np.zeros(n, dtype=np.int64)
        self.turn = 0
        for i in range(n):
            self._insert(i, int(height[i]), ef)

    def _far(self, q: np.ndarray, qq: float, nodes: list[int]) -> list[float]:
        return (self.squares[nodes] - 2.0 * (self.v[nodes] @ q) + qq).tolist()

    def _walk(self, q: np.ndarray, qq: float, start: list[tuple[float, int]], ef: int, level: int) -> list[tuple[float, int]]:
        """The ef nearest found from the start nodes, nearest first."""
        links, seen = self.links[level], self.seen
        self.turn += 1
        turn = self.turn
        seen[[i for _, i in start]] = turn
        todo = list(start)
        heapq.heapify(todo)
        best = [(-d, i) for d, i in start]
        heapq.heapify(best)
        while todo:
            d, i = heapq.heappop(todo)
            if len(best) >= ef and d > -best[0][0]:
                break
            near = np.array(links[i], dtype=np.int64)
            if not len(near):
                continue
            near = near[seen[near] != turn]
            if not len(near):
                continue
            seen[near] = turn
            far = self.squares[near] - 2.0 * (self.v[near] @ q) + qq
            if len(best) >= ef:
                ok = far < -best[0][0]
                near, far = near[ok], far[ok]
            for x, j in zip(far.tolist(), near.tolist()):
                if len(best) < ef:
                    heapq.heappush(best, (-x, j))
                elif x < -best[0][0]:
                    heapq.heapreplace(best, (-x, j))
                else:
                    continue
                heapq.heappush(todo, (x, j))
        return sorted((-d, i) for d, i in best)

    def _spread(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Of the nodes found, those nearer to the new one than to any chosen before; then the nearest of the rest."""
        nodes = [i for _, i in found]
        v = self.v[nodes]
        sq = self.squares[nodes]
        between = sq[:, None] + sq[None, :] - 2.0 * (v @ v.T)
        chosen: list[int] = []
        limit = np.full(len(nodes), np.inf)
        for k, (d, _) in enumerate(found):
            if d < limit[k]:
                chosen.append(k)
                if len(chosen) >= most:
                    break
                np.minimum(limit, between[k], out=limit)
        if len(chosen) < most // 2:
            rest = [k for k in range(len(nodes)) if k not in set(chosen)]
            chosen += rest[: most // 2 - len(chosen)]
        return [nodes[k] for k in chosen]

    def _insert(self, i: int, height: int, ef: int) -> None:
        q, qq = self.v[i], float(self.squares[i])
        if i:
            start = [(self._far(q, qq, [self.entry])[0], self.entry)]
            for level in range(self.top, height, -1):
                start = self._walk(q, qq, start, 1, level)[:1]
            for level in range(min(self.top, height), -1, -1):
                start = self._walk(q, qq, start, ef, level)
                most = self.degree * 2 if level == 0 else self.degree
                near = self._spread(start, self.degree)
                self.links[level][i] = near
                for j in near:
                    own = self.links[level][j]
                    own.append(i)
                    if len(own) > most + self.degree:  # pruned now and then, not at every link
                        self._prune(level, j, most)
        for level in range(height, -1, -1):
            self.links[level].setdefault(i, [])
        if i == 0 or height > self.top:
            self.entry, self.top = i, height

    def _prune(self, level: int, j: int, most: int) -> None:
        own = list(dict.fromkeys(self.links[level][j]))
        far = self._far(self.v[j], float(self.squares[j]), own)
        self.links[level][j] = self._spread(sorted(zip(far, own)), most)

    def flat(self) -> list[bytes]:
        """Per level: how many nodes, the nodes, the ends of their neighbour lists, all neighbours; 32-bit numbers."""
        out = []
        for level in self.links:
            nodes = sorted(level)
            ends = np.cumsum([len(level[i]) for i in nodes])
            flat = [j for i in nodes for j in level[i]]
            out.append(np.concatenate([[len(nodes)], nodes, ends, flat]).astype("<i4").tobytes())
        return out

    @classmethod
    def load(cls, vectors: np.ndarray, levels: list[bytes], entry: int, top: int) -> SmallWorld:
        g = cls.__new__(cls)
        g.v = np.ascontiguousarray(vectors, dtype=np.float64)
        g.squares = np.einsum("ij,ij->i", g.v, g.v)
        g.seen, g.turn, g.entry, g.top, g.links = np.zeros(len(g.v), dtype=np.int64), 0, entry, top, []
        for raw in levels:
            a = np.frombuffer(raw, dtype="<i4")
            n = int(a[0])
            ends = np.r_[0, a[1 + n:1 + 2 * n]]
            flat = a[1 + 2 * n:]
            g.links.append({int(i): flat[ends[k]:ends[k + 1]] for k, i in enumerate(a[1:1 + n].tolist())})
        return g

    def nearest(self, q: np.ndarray, k: int, ef: int = EF_SEARCH) -> list[int]:
        if not len(self.v):
            return []
        q = np.asarray(q, dtype=np.float64)
        qq = float(q @ q)
        start = [(self._far(q, qq, [self.entry])[0], self.entry)]
        for level in range(self.top, 0, -1):
            start = self._walk(q, qq, start, 1, level)[:1]
        return [i for _, i in self._walk(q, qq, start, max(ef, k), 0)[:max(ef, k)]]


# -- the job ---------------------------------------------------------------------

def usable(v: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def build(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The written index, a row per shard; rows: vec_id, v."""
    # the k + 1 smallest ids of each distinct vector, cut before the shuffle
    nth = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    nodes = written(
        rows.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    shards = max(1, -(-nodes.count() // shard_rows))

    def shard(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values("order", kind="stable")
        vectors = np.stack(f["v"].to_numpy()).astype(np.float64)
        graph = SmallWorld(vectors)
        ids = [np.asarray(x, dtype=np.int64) for x in f["ids"]]
        return pd.DataFrame([{
            "shard": int(f["shard"].iloc[0]), "width": vectors.shape[1], "vectors": vectors.tobytes(),
            "ids": np.concatenate(ids).tobytes(), "ends": np.cumsum([len(x) for x in ids]).astype("<i8").tobytes(),
            "levels": graph.flat(), "entry": graph.entry, "top": graph.top,
        }])

    dealt = nodes.select("v", "ids", F.xxhash64("v").alias("order")).withColumn("shard", F.pmod("order", F.lit(shards)).cast("int"))
    schema = "shard int, width int, vectors binary, ids binary, ends binary, levels array<binary>, entry int, top int"
    return written(dealt.groupBy("shard").applyInPandas(shard, schema))


def search(vectors: DataFrame, queries: Column, k: int = 10, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows of each query row; vectors: vec_id, embedding."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).filter(usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    rows = rows.filter((F.size("v") == (common["n"] if common else 0)) & F.col("vec_id").isNotNull())
    index = build(rows, k, shard_rows)
    asked = written(rows.filter(queries).select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.monotonically_increasing_id().alias("row")))
    blocks = max(1, -(-asked.count() // BLOCK_ROWS))
    shards = index.agg(F.max("shard")).first()[0]
    every = F.sequence(F.lit(0), F.lit(shards or 0))
    sent = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(every))
    held = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def look(qs: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        for s in shard.itertuples():
            v = np.frombuffer(s.vectors, dtype=np.float64).reshape(-1, s.width)
            graph = SmallWorld.load(v, list(s.levels), s.entry, s.top)
            ids, ends = np.frombuffer(s.ids, dtype="<i8"), np.r_[0, np.frombuffer(s.ends, dtype="<i8")]
            for query_id, q, row in zip(qs["query_id"], qs["q"], qs["row"]):
                q = np.asarray(q, dtype=np.float64)
                found = np.array(graph.nearest(q, k + 1))
                with np.errstate(over="ignore"):
                    far = np.sqrt(((graph.v[found] - q) ** 2).sum(axis=1))
                near: list[tuple[float, int]] = []
                for d, i in sorted(zip(far.tolist(), found.tolist())):
                    if len(near) > k and d > near[k][0]:
                        break
                    near += [(d, int(x)) for x in ids[ends[i]:ends[i + 1]]]
                near.sort()
                own = next((n for n, (_, x) in enumerate(near) if x == query_id), None)
                if own is not None:
                    del near[own]
                out += [(row, query_id, x, d) for d, x in near[:k]]
        return pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"])

    near = sent.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInPandas(look, "row long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("row").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
