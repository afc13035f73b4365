"""Personal data by weak supervision.

Base spans follow fixed rules (email, ip, card, phone) and always stay. Further candidates (keys
and passwords, numbers that miss a base rule, written-out addresses) are judged:
labelers built on patterns, gazetteers, context, checksums and shape vote; expectation-maximisation over
the counts of vote patterns of all documents estimates how reliable each labeler is, over base spans, which are known to be
right, and candidates of all kinds together, and which share of each kind is right;
a logistic span classifier is trained on the resulting probabilities over votes and surface
features and decides which candidates are spans. Only counts per pattern leave the tasks.

Edges: a null text is an empty one (no spans, the digest of an empty list); repeated rows and ids are
judged each for itself; a null doc_id is kept; an empty table gives an empty result; further columns are
ignored. All scans are linear in the length of the text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, sigmoid, text_rows

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number", "written")
KINDS = BASE + ADDED
THRESHOLD = 0.5
MIN_RELIABLE = 1e-3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_RUN = re.compile(r"[0-9]+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")  # a match never starts inside a run of digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NAMED = re.compile(r"(?<![A-Za-z0-9])(token|secret|password|passwd|pwd|passwort|contraseña|api[_-]?key|access[_-]?key|auth[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9_+/-]{6,})", re.I)
_LONG = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{24,}")
_NUMBER = re.compile(r"[0-9](?:[\x20().-]{0,2}[0-9]){6,}")
_AT = re.compile(r"[\[(]\s?at\s?[\])]", re.I)
_WRITTEN = re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,64}\s?[\[(]\s?at\s?[\])]\s?[A-Za-z0-9-]{2,64}(?:\s?[\[(]\s?dot\s?[\])]\s?[A-Za-z0-9-]{2,64})+", re.I)

# fixed values: gazetteers and cue words
_MAIL_HOSTS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "gmx.de", "web.de", "orange.fr", "icloud.com", "example.com")
_CARD_HEADS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "22", "23", "24", "25", "26", "27")
_CALL_CODES = ("+1", "+33", "+34", "+44", "+49", "+52", "+54", "+57")
_FOR = {
    "email": re.compile(r"mail|contact|write|schreib|escrib|écri", re.I),
    "ip": re.compile(r"\bip\b|addr|server|host|login", re.I),
    "card": re.compile(r"card|visa|master|credit|kredit|tarjeta|carte", re.I),
    "phone": re.compile(r"phone|tel|call|mobil|fax|móvil|rufen", re.I),
    "secret": re.compile(r"token|secret|passw|pwd|key|auth", re.I),
    "number": re.compile(r"phone|tel\b|call|mobil|card|account|konto|iban|ssn|passport|cuenta|compte", re.I),
    "written": re.compile(r"mail|contact|write|schreib|escrib|écri", re.I),
}
_AGAINST = re.compile(r"version|isbn|issn|order|invoice|page|section|rfc|license|lizenz|licencia|chapter|figure|sha|md5|commit", re.I)
_CONTEXT = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _byte(part: str) -> bool:
    p = part.lstrip("0")
    return len(p) < 4 and int(p or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; code points."""
    out, free = [], 0
    at = text.find("@")
    while at >= 0:  # a local part never holds an @: each is looked at once
        left = at
        while left > free and text[left - 1] in _LOCAL:
            left -= 1
        m = _DOMAIN.match(text, at) if left < at else None
        if m:
            out.append(("email", left, m.end()))
            free = m.end()
        else:
            free = max(free, at + 1)
        at = text.find("@", free)
    if _DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_byte, m.group().split(".")))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16:
                d = re.sub(r"[^0-9]", "", m.group())
                if 16 <= len(d) <= 19 and luhn(d):
                    out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= len(_DIGIT.findall(m.group())) <= 15]
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Further candidates, none overlapping a base span or an earlier candidate."""
    taken: list[tuple[int, int]] = []
    for _, s, e in sorted(base, key=lambda x: x[1:]):  # base spans of two kinds may overlap: joined
        if taken and s < taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    found: list[tuple[str, int, int]] = []

    def add(kind: str, start: int, end: int) -> None:
        at = bisect_left(taken, (start, end))
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or taken[at][0] >= end):
            taken.insert(at, (start, end))
            found.append((kind, start, end))

    if "=" in text or ":" in text:
        for m in _NAMED.finditer(text):
            add("secret", m.start(2), m.end(2))
    if _DIGIT.search(text):
        for m in _LONG.finditer(text):
            if _DIGIT.search(m.group()):
                add("secret", m.start(), m.end())
        for m in _NUMBER.finditer(text):
            add("number", m.start(), m.end())
    if _AT.search(text):
        for m in _WRITTEN.finditer(text):
            add("written", m.start(), m.end())
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (order[s[0]], s[1]))


# -- labelers: 1 for, -1 against, 0 no vote ----------------------------------------

LABELERS = ("pattern", "gazetteer", "context", "checksum", "shape")


def votes(text: str, kind: str, start: int, end: int) -> tuple[int, ...]:
    value = text[start:end]
    before = text[max(0, start - _CONTEXT):start]
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "secret":
        named = _NAMED.search(text, max(0, start - 40), min(len(text), start + 8))
        pattern = 1 if re.fullmatch(r"[0-9a-f]{32,}|[0-9A-F]{32,}|AKIA[0-9A-Z]{16}|[A-Za-z0-9_-]{40,}", value) else 0
        gazetteer = 1 if named else -1
        checksum = 0
        kinds = Counter(value)
        shape = 1 if len(kinds) >= 10 and bool(digits) and len(digits) < len(value) else -1
    elif kind in ("card", "number"):
        groups = _RUN.findall(value)
        # a number of a card's length, or such numbers side by side
        long = [digits] if 13 <= len(digits) <= 19 else [g for g in groups if 13 <= len(g) <= 19]
        pattern = 1 if kind == "card" or len(digits) in (9, 10, 11) and len(groups) > 2 or long else -1
        gazetteer = 1 if any(g.startswith(_CARD_HEADS) for g in long) else 0
        checksum = (1 if any(map(luhn, long)) else -1) if long else 0
        shape = -1 if len(set(digits)) < 4 else 1 if len(digits) >= 9 else -1
    elif kind == "ip":
        parts = value.split(".")
        pattern, checksum = 1, 1 if all(p == "0" or p[0] != "0" for p in parts) else -1
        gazetteer = -1 if value.startswith(("0.", "127.", "255.")) else 1
        shape = 1 if len(value) >= 11 else 0
    elif kind == "phone":
        pattern, checksum = 1, 0
        gazetteer = 1 if value.startswith(_CALL_CODES) else 0
        shape = 1 if 10 <= len(digits) <= 13 else 0
    else:
        pattern, checksum = 1, 0
        gazetteer = 1 if value.lower().endswith(_MAIL_HOSTS) else 0
        shape = 1 if re.search(r"[A-Za-z]{2,}$", value) else -1
    context = 1 if _FOR[kind].search(before) else -1 if _AGAINST.search(before) else 0
    return (pattern, gazetteer, context, checksum, shape)


def surface(text: str, start: int, end: int) -> tuple[int, ...]:
    """A few coarse features of the span and its edges."""
    value = text[start:end]

    def edge(c: str) -> int:
        return 0 if not c or c.isspace() else 1 if c.isalnum() else 2

    length = min(5, (end - start).bit_length() - 2)
    separators = min(3, sum(map(value.count, " .()-")))
    return (length, separators, edge(text[start - 1:start]), edge(text[end:end + 1]))


def judged(text: str) -> Iterator[tuple[str, int, int, bool, str]]:
    """(kind, start, end, base, key): key holds kind, votes and surface features."""
    base = base_spans(text)
    for is_base, spans in ((True, base), (False, candidates(text, base))):
        for kind, s, e in spans:
            key = (KINDS.index(kind), *votes(text, kind, s, e), *surface(text, s, e))
            yield kind, s, e, is_base, ",".join(map(str, key))


# -- learning ----------------------------------------------------------------------

@dataclass
class SpanModel:
    """Probability of each seen key; unseen keys are scored by the logistic layer."""

    coef: np.ndarray

    def probability(self, keys: list[str]) -> np.ndarray:
        return sigmoid(_design(keys) @ self.coef) if keys else np.zeros(0)


def _design(keys: list[str]) -> np.ndarray:
    k = np.array([list(map(int, x.split(","))) for x in keys], dtype=np.int64)
    cols = [np.ones(len(k))]
    cols += [(k[:, 0] == i).astype(float) for i in range(len(KINDS))]
    n = len(LABELERS)
    cols += [(k[:, 1 + j] == v).astype(float) for j in range(n) for v in (1, -1)]
    cols += [(k[:, 1 + n + j] == v).astype(float) for j, width in enumerate((6, 4, 3, 3)) for v in range(width)]
    return np.stack(cols, axis=1)


def reliabilities(pattern: np.ndarray, count: np.ndarray, kind: np.ndarray | None = None, known: np.ndarray | None = None, rounds: int = 50) -> np.ndarray:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1): P(true) of each pattern.

    Each labeler has one table P(vote | true), P(vote | false) for all kinds, each kind its own share of true spans
    among those not `known` to be true. Patterns start from their votes, one against counting as two for.
    """
    kind = np.zeros(len(pattern), dtype=int) if kind is None else np.unique(kind, return_inverse=True)[1]
    known = np.zeros(len(pattern), dtype=bool) if known is None else known
    p = np.where(known, 1.0, np.clip(0.5 + 0.2 * ((pattern > 0).sum(axis=1) - 2 * (pattern < 0).sum(axis=1)), 0.05, 0.95))
    open_ = np.where(known, 0.0, count)
    of_kind = np.bincount(kind, weights=open_)
    hot = np.stack([pattern == v for v in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        logs = []
        for q in (p, 1 - p):
            w = q * count
            # a weak prior: labelers are better than chance
            prior = np.array([0.5, 1.0, 1.5]) if q is p else np.array([1.5, 1.0, 0.5])
            t = np.einsum("n,njv->jv", w, hot) + prior
            t /= t.sum(axis=1, keepdims=True)
            share = (np.bincount(kind, weights=q * open_) + 1) / (of_kind + 2)
            logs.append(np.einsum("njv,jv->n", hot, np.log(t)) + np.log(share)[kind])
        new = np.where(known, 1.0, sigmoid(logs[0] - logs[1]))
        if np.abs(new - p).max() < MIN_RELIABLE:
            return new
        p = new
    return p


def fit(docs: DataFrame) -> SpanModel:
    """Counts per key over all documents (a bounded set of keys), then EM, then the classifier."""
    def count(f: pd.DataFrame) -> pd.DataFrame:
        by = Counter(key for t in f["text"] for *_, key in judged(t))
        return pd.DataFrame({"key": list(by), "n": list(by.values())})

    counts = map_rows(text_rows(docs), count, "key string, n long").groupBy("key").agg(F.sum("n").alias("n")).orderBy("key").collect()
    if not counts:
        return SpanModel(np.zeros(_design(["0,0,0,0,0,0,0,0,0,0"]).shape[1]))
    keys, n = [r["key"] for r in counts], np.array([float(r["n"]) for r in counts])
    k = np.array([list(map(int, x.split(","))) for x in keys])
    seen, back = np.unique(k[:, :1 + len(LABELERS)], axis=0, return_inverse=True)  # kind and votes
    back = back.ravel()
    target = reliabilities(seen[:, 1:], np.bincount(back, weights=n), seen[:, 0], seen[:, 0] < len(BASE))[back]
    x, w = _design(keys), np.zeros(_design(keys[:1]).shape[1])
    scale = n / n.sum() * min(n.sum(), 1e6)
    for _ in range(50):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (scale * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) * 0.1, x.T @ (scale * (target - p)) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return SpanModel(w)


def all_spans(texts: list[str], model: SpanModel) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """Base and added spans of every text."""
    found = [list(judged(t)) for t in texts]
    open_ = [(i, s) for i, spans in enumerate(found) for s in spans if not s[3]]
    p = model.probability([s[4] for _, s in open_])
    added: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    for (i, s), q in zip(open_, p):
        if q >= THRESHOLD:
            added[i].append(s[:3])
    return [([s[:3] for s in spans if s[3]], more) for spans, more in zip(found, added)]


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def find(docs: DataFrame, model: SpanModel) -> DataFrame:
    """Counts and spans of every row."""
    def run(f: pd.DataFrame) -> pd.DataFrame:
        rows = []
        for base, more in all_spans(f["text"].tolist(), model):
            by = Counter(k for k, *_ in base)
            rows.append((*[by[k] for k in BASE], hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(base + more)))
        out = pd.DataFrame(rows, columns=[*(f"n_{k}" for k in BASE), "base_sha256", "spans"])
        out.insert(0, "doc_id", f["doc_id"])
        return out

    return map_rows(text_rows(docs), run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, model: SpanModel) -> DataFrame:
    """All rows and columns of docs; in text each span is replaced by its kind in brackets, n_chars follows."""
    at = docs.columns.index("text")
    size = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def hide(text: str, spans: list[tuple[str, int, int]]) -> str:
        out, last = [], 0
        for kind, s, e in sorted(spans, key=lambda x: (x[1], x[2])):
            if s >= last:
                out += [text[last:s], f"[{kind.upper()}]"]
            last = max(last, e)
        return "".join(out) + text[last:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            hidden = [t and hide(t, base + more) for t, (base, more) in zip(texts, all_spans([t or "" for t in texts], model))]
            columns = list(b.columns)
            columns[at] = pa.array(hidden, b.schema.types[at])
            if size is not None:
                lengths = [old if h is None or h == t else len(h) for h, t, old in zip(hidden, texts, columns[size].to_pylist())]
                columns[size] = pa.array(lengths, b.schema.types[size])
            yield pa.RecordBatch.from_arrays(columns, schema=b.schema)

    return docs.mapInArrow(run, docs.schema)
