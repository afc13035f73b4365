"""Toxicity by a weighted finite-state grammar over clauses.

Words become symbols (insult, threat, target, negation, report, quote, other); five
sequential transducers are composed into one machine that reads the symbols of
a clause and tells plain from aimed, negated and reported insults and threats.
A logistic layer weighs what the machine found; the insult lexicon is a fixed
list plus word stems learned from labelled rows.

Edges: a null text is an empty one; an empty text has a score too (that of a
document in which nothing matches); repeated rows and ids are scored each for
itself; a null doc_id counts as not held out and is never learned from; labels
that are null or not 0/1 are ignored, an id labelled both ways counts as toxic; without any
usable label the fixed lexicon and prior weights are used; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filter_rows, fold_of, labelled, map_rows, sigmoid, text_rows

#: At most so many labelled rows are learned from, those of the smallest id hashes.
FIT_ROWS = 20_000
THRESHOLD = 0.3
STEM_LENGTHS = (4, 5, 6, 7)
SEED_WEIGHT = 3.0

# fixed values: lexicons
INSULTS = (
    "idiot moron stupid loser scum trash pathetic worthless disgusting clown imbecile dumb fool filth vermin "
    "dummkopf trottel arschloch abschaum idiota imbécil estúpido basura escoria connard crétin ordure minable"
).split()
THREATS = "kill hurt destroy stab shoot punch strangle murder töten umbringen matar tuer frapper".split()
TARGETS = "you your yours yourself u ur he she they him them these those people everyone du dich dir ihr euch tú usted ustedes vosotros tu toi vous".split()
NEGATIONS = "not never isn't aren't wasn't don't doesn't no nicht kein keine niemals nunca jamás pas jamais".split()
REPORTS = "said says say told called wrote quoted reported claimed sagte schrieb dijo llamó escribió dit appelé écrit".split()

WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.;:!?\n]|[\"“”«»]")


# -- transducers -----------------------------------------------------------------

@dataclass(frozen=True)
class Transducer:
    """Sequential transducer: (state, symbol) -> (next state, output symbol, weight).

    A symbol without an arc passes unchanged and leaves the state as `idle` tells.
    """

    arcs: dict[tuple[int, str], tuple[int, str, float]]
    idle: dict[int, int] = field(default_factory=dict)

    def step(self, state: int, symbol: str) -> tuple[int, str, float]:
        return self.arcs.get((state, symbol), (self.idle.get(state, state), symbol, 0.0))


def compose(*machines: Transducer) -> Transducer:
    """The machine that runs all one after another; weights along a path add up."""
    symbols = {s for m in machines for (_, s) in m.arcs} | {o for m in machines for (_, o, _) in m.arcs.values()} | {"O"}
    start = (0,) * len(machines)
    number, todo, arcs = {start: 0}, [start], {}
    while todo:
        states = todo.pop()
        for s in symbols:
            out, weight, after = s, 0.0, []
            for m, q in zip(machines, states):
                q, out, w = m.step(q, out)
                after.append(q)
                weight += w
            after = tuple(after)
            if after not in number:
                number[after] = len(number)
                todo.append(after)
            arcs[number[states], s] = (number[after], out, weight)
    return Transducer(arcs)


# I insult, H threat, T target, N negation, R report, Q quotation mark, O other;
# outputs: A aimed insult, n negated, r reported, D threat against a target
NEGATION = Transducer(
    {(0, "N"): (3, "N", 0.0)} | {(k, "N"): (3, "N", 0.0) for k in (1, 2, 3)}
    | {(k, s): (k - 1, "n", 0.0) for k in (1, 2, 3) for s in "IH"},
    idle={3: 2, 2: 1, 1: 0},
)
QUOTATION = Transducer({(0, "Q"): (1, "Q", 0.0), (1, "Q"): (0, "Q", 0.0), (1, "R"): (2, "R", 0.0), (0, "R"): (2, "R", 0.0), **{(2, s): (2, "r", 0.0) for s in "IH"}})
TARGET = Transducer({(0, "T"): (1, "T", 0.0), (1, "I"): (1, "A", 1.0), (0, "I"): (2, "I", 0.0), (2, "T"): (1, "T", 0.5)})
THREAT = Transducer({(0, "H"): (1, "H", 0.5), (1, "T"): (0, "D", 1.0)})
INSULT = Transducer({(0, "I"): (1, "I", 1.0), (1, "I"): (1, "I", 1.5), (1, "A"): (1, "A", 1.5), (0, "A"): (1, "A", 1.5), (0, "n"): (0, "n", 0.25), (0, "r"): (0, "r", 0.25)})
GRAMMAR = compose(NEGATION, QUOTATION, TARGET, THREAT, INSULT)

FIXED = {w: s for words, s in ((TARGETS, "T"), (NEGATIONS, "N"), (REPORTS, "R"), (THREATS, "H")) for w in words}
FEATURES = ("plain", "aimed", "negated", "reported", "threats", "best_clause", "total", "kinds")


@dataclass
class Grammar:
    """Lexicon weights by whole word (key `=word`) or stem, and the logistic layer."""

    lexicon: dict[str, float]
    coef: np.ndarray
    intercept: float

    def __post_init__(self) -> None:
        self._seen: dict[str, float] = {}

    def weight(self, word: str) -> float:
        w = self._seen.get(word)
        if w is None:
            if len(self._seen) > 100_000:
                self._seen.clear()
            get = self.lexicon.get
            w = max([get("=" + word, 0.0), *[get(word[:k], 0.0) for k in STEM_LENGTHS if len(word) >= k]])
            self._seen[word] = w
        return w

    def features(self, text: str) -> list[float]:
        low = text.lower()
        hits = {w: x for w in set(WORD.findall(low)) if (x := self.weight(w)) or FIXED.get(w) == "H"}
        if not hits:
            return [0.0] * len(FEATURES)
        sums, best, total = Counter(), 0.0, 0.0
        state, clause, matched = 0, 0.0, False
        for token in TOKEN.findall(low):
            if token in ".;:!?\n":
                if matched:
                    best, total = max(best, clause), total + clause
                state, clause, matched = 0, 0.0, False
                continue
            strength = hits.get(token, 0.0)
            symbol = "I" if strength else FIXED.get(token) or ("Q" if token in "\"“”«»" else "O")
            state, out, w = GRAMMAR.step(state, symbol)
            if w:
                matched = True
                clause += w * (strength or SEED_WEIGHT)
            if out in "IAnrHD":
                sums[out] += strength or SEED_WEIGHT
        if matched:
            best, total = max(best, clause), total + clause
        log = np.log1p
        return [log(sums["I"]), log(sums["A"]), log(sums["n"]), log(sums["r"]), log(sums["H"] + sums["D"]), log(best), log(total), log(sum(hits.values()))]

    def scores(self, texts: Iterable[str]) -> np.ndarray:
        x = np.array([self.features(t) for t in texts], dtype=np.float64).reshape(-1, len(FEATURES))
        return sigmoid(x @ self.coef + self.intercept)


PRIOR = Grammar({"=" + w: SEED_WEIGHT for w in INSULTS}, np.array([0.3, 0.6, 0.1, 0.1, 0.5, 0.8, 0.6, 0.5]), -2.2)


# -- learning ----------------------------------------------------------------------

def stems(text: str) -> set[str]:
    out = set()
    for w in set(WORD.findall(text.lower())):
        out.add("=" + w)
        for k in STEM_LENGTHS:
            if len(w) >= k:
                out.add(w[:k])
    return out


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Grammar:
    """Lexicon from stem counts of labelled rows, then the logistic layer on their features."""
    sample = labelled(docs, labels, "toxic", rows)

    def count(f: pd.DataFrame) -> pd.DataFrame:
        by = [Counter(), Counter()]
        for t, y in zip(f["text"], f["y"]):
            by[y].update(stems(t))
            by[y][""] += 1
        keys = sorted(set(by[0]) | set(by[1]))
        return pd.DataFrame({"stem": keys, "clean": [by[0][k] for k in keys], "toxic": [by[1][k] for k in keys]})

    # copies of one text count once: their words would look like a pattern
    once = sample.groupBy(F.xxhash64("text").alias("_h")).agg(F.min("doc_id").alias("doc_id")).select("doc_id")
    first = sample.join(F.broadcast(once), "doc_id", "left_semi")
    counts = map_rows(first, count, "stem string, clean long, toxic long").groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    n = counts.filter("stem = ''").first()
    if n is None or not n["toxic"] or not n["clean"]:
        return PRIOR
    odds = F.log((F.col("toxic") + 0.5) / (n["toxic"] + 1.0)) - F.log((F.col("clean") + 0.5) / (n["clean"] + 1.0))
    heavy = counts.filter((F.col("stem") != "") & (F.col("toxic") >= max(5, n["toxic"] // 100))).withColumn("w", odds).filter("w >= 3")
    # a stem is in a hundredth of the toxic texts of the bounded sample at least: there are at most a hundred times the stems of one text
    learned = {r["stem"]: float(r["w"]) for r in heavy.orderBy("stem").collect()}
    lexicon = dict(PRIOR.lexicon)
    for k, w in learned.items():
        lexicon[k] = max(w, lexicon.get(k, 0.0))
    probe = Grammar(lexicon, PRIOR.coef, PRIOR.intercept)

    def measure(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"y": f["y"], "x": [probe.features(t) for t in f["text"]]})

    rows_ = map_rows(sample, measure, "y int, x array<double>").toPandas()  # at most `rows` rows of eight numbers
    x, y = np.array(rows_["x"].tolist()), rows_["y"].to_numpy(dtype=float)
    coef, intercept = logistic(x, y)
    return Grammar(lexicon, coef, intercept)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    a = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(a.shape[1]), np.r_[np.full(x.shape[1], ridge), 1e-6]
    for _ in range(50):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def score(docs: DataFrame, model: Grammar) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"doc_id": f["doc_id"], "score": model.scores(f["text"])})

    out = map_rows(text_rows(docs), run, "doc_id long, score double")
    held = F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Grammar) -> DataFrame:
    """The rows of docs, all columns as they are, whose text is not found toxic."""
    at = docs.columns.index("text")
    return filter_rows(docs, lambda batch: model.scores([t or "" for t in batch.column(at).to_pylist()]) < THRESHOLD)
