"""Quality by a regularised quadratic discriminant over document statistics.

Each class is a Gaussian over transformed statistics of the text (counts and lengths by
logarithm, shares by a smoothed log odds). Class covariances are shrunk towards their
diagonal; a score is the difference of log densities from Mahalanobis distances with
cached inverse Cholesky factors, scaled to a probability.

Edges: a null text is an empty one; an empty text has the statistics of zero words and a score like any
other; repeated rows and ids are scored each for itself; a null doc_id counts as not held out and is never
learned from; labels that are null or not 0/1 are ignored; with labels of one class only every score is that
class's share; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, labelled, map_rows, sigmoid, text_rows

#: At most so many labelled rows are learned from, those of the smallest id hashes.
FIT_ROWS = 20_000
THRESHOLD = 0.7
SHRINKAGE = 0.05

_SYMBOLS = re.compile(r"[#$%&*+/<=>@\\^_`{|}~\[\]]")
_STOPS = re.compile(r"[.!?]")
_DIGITS = re.compile(r"[0-9]")

STATISTICS = (
    "words", "word_length", "word_spread", "upper", "capitals", "symbols", "pipes", "shouts", "commas", "stops",
    "digits", "distinct_words", "top_word", "distinct_pairs", "echo", "distinct_lines", "line_words", "packed", "short_words", "odd_ends",
)


def _odds(part: float, whole: float) -> float:
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def statistics(text: str) -> list[float]:
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n) if n else np.zeros(1)
    low = [w.lower() for w in words]
    counts = Counter(low)
    lines = [x for x in text.split("\n") if x.strip()]
    raw = text.encode("utf-8", "surrogatepass")
    chars = len(text)
    symbols = len(_SYMBOLS.findall(text))
    return [
        np.log1p(n),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        _odds(sum(map(str.isupper, words)), n),
        _odds(sum(map(str.istitle, words)), n),
        _odds(symbols, chars),
        _odds(text.count("|"), n + text.count("|")),
        _odds(text.count("!"), n + text.count("!")),
        _odds(text.count(","), n + text.count(",")),
        _odds(len(_STOPS.findall(text)), chars),
        _odds(len(_DIGITS.findall(text)), chars),
        _odds(len(counts), n + 1),
        _odds(max(counts.values(), default=0), n + 1),
        _odds(len(set(zip(low, low[1:]))), n),
        _odds(sum(map(str.__eq__, low, low[1:])), n),
        _odds(len(set(lines)), len(lines) + 1),
        np.log1p(n / max(1, len(lines))),
        np.log((len(zlib.compress(raw, 1)) + 1) / (len(raw) + 12)),
        _odds(int((lengths <= 2).sum()) if n else 0, n),
        _odds(sum(1 for w in words if not w[-1].isalnum() and w[-1] not in ".,"), n),
    ]


def measured(texts: Iterable[str]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], dtype=np.float64).reshape(-1, len(STATISTICS))


@dataclass
class Discriminant:
    """Per class: mean, inverse Cholesky factor of the shrunk covariance, half its log determinant; then the scale to a probability."""

    classes: list[tuple[np.ndarray, np.ndarray, float]]
    slope: float
    offset: float

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density of class 1 less that of class 0."""
        density = [-0.5 * (((x - m) @ inv.T) ** 2).sum(axis=1) - half for m, inv, half in self.classes]
        return density[1] - density[0]

    def scores(self, texts: Iterable[str]) -> np.ndarray:
        x = measured(texts)
        if not self.classes:
            return np.full(len(x), sigmoid(np.array(self.offset)))
        return sigmoid(self.slope * squashed(self.difference(x)) + self.offset)


def squashed(d: np.ndarray) -> np.ndarray:
    """Signed logarithm: far tails of the densities keep their order without saturating."""
    return np.sign(d) * np.log1p(np.abs(d))


def gaussian(n: float, total: np.ndarray, products: np.ndarray, shrinkage: float) -> tuple[np.ndarray, np.ndarray, float]:
    mean = total / n
    cov = products / n - np.outer(mean, mean)
    spread = np.maximum(np.diag(cov), 1e-3)
    cov = (1 - shrinkage) * cov + np.diag(shrinkage * spread + 1e-3)
    factor = np.linalg.cholesky(cov)
    return mean, np.linalg.inv(factor), float(np.log(np.diag(factor)).sum())


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, shrinkage: float = SHRINKAGE) -> Discriminant:
    """Moments per class by tasks, summed by Spark; the scale from the differences of the same bounded rows."""
    d = len(STATISTICS)

    def measure(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"y": f["y"], "x": list(measured(f["text"]))})

    def moments(f: pd.DataFrame) -> pd.DataFrame:
        out = []
        for y, g in f.groupby("y"):
            x = np.stack(g["x"].to_numpy())
            values = np.r_[len(x), x.sum(axis=0), (x.T @ x).ravel()]
            out.append(pd.DataFrame({"y": int(y), "at": np.arange(len(values)), "value": values}))
        return pd.concat(out, ignore_index=True)

    sample = map_rows(labelled(docs, labels, "quality", rows), measure, "y int, x array<double>").cache()
    sums = map_rows(sample, moments, "y int, at int, value double").groupBy("y", "at").agg(F.sum("value").alias("value")).collect()
    by: dict[int, np.ndarray] = {}
    for r in sums:  # 2 (1 + d + d*d) numbers
        by.setdefault(r["y"], np.zeros(1 + d + d * d))[r["at"]] = r["value"]
    if len(by) < 2:
        sample.unpersist()
        share = 0.5 if not by else 0.99 if 1 in by else 0.01
        return Discriminant([], 0.0, float(np.log(share / (1 - share))))
    classes = [gaussian(v[0], v[1:1 + d], v[1 + d:].reshape(d, d), shrinkage) for _, v in sorted(by.items())]
    model = Discriminant(classes, 1.0, 0.0)

    def differ(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"y": f["y"], "d": model.difference(np.stack(f["x"].to_numpy()))})

    rows_ = map_rows(sample, differ, "y int, d double").toPandas()  # at most `rows` pairs of numbers
    sample.unpersist()
    z, y = squashed(rows_["d"].to_numpy()), rows_["y"].to_numpy(dtype=float)
    w = np.zeros(2)
    a = np.c_[z, np.ones(len(z))]
    for _ in range(50):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag([1e-2, 1e-2]), a.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return Discriminant(classes, float(w[0]), float(w[1]))


def score(docs: DataFrame, model: Discriminant) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": f["doc_id"], "score": model.scores(f["text"])})

    out = map_rows(text_rows(docs), run, "doc_id long, score double")
    held = F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
