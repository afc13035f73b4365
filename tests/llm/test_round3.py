"""Hard negatives, line frequencies and collocations against brute force, and their edges."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotlens.llm import ann, hardneg, linefreq, stripes
from lotlens.llm import queries as llm
from tests.conftest import SF_DIR

# -- hard negatives ----------------------------------------------------------


def naive_negatives(rows, is_anchor, positives=5, negatives=5):
    rows = [(i, lab, [math.floor(Fraction(x) * 256) for x in v]) for i, lab, v in rows]
    out = []
    for i, lab, v in rows:
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in rows if j != i]
        scored = [(max(-2**63, min(2**63 - 1, s)), j, other) for s, j, other in scored]
        order = sorted(scored, key=lambda r: (-r[0], r[1]))
        for p, j, _ in [r for r in order if r[2] == lab][:positives]:
            inside = [r for r in order if r[2] != lab and 80 * p <= 100 * r[0] <= 100 * p][:negatives]
            out += [(i, j, k + 1, r[1], p, r[0]) for k, r in enumerate(inside)]
    return sorted(out)


def mined(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, label int, embedding array<double>, v string, norm double").repartition(3)
    return sorted(tuple(r) for r in hardneg.mine(df, F.col("vec_id") % 10 == 0, **how).collect())


@pytest.mark.parametrize("shard_rows,references", [(8192, 16), (40, 3), (40, 0)])
def test_negatives_by_brute_force(spark, shard_rows, references):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 12))
    v = centres[rng.integers(0, 6, 300)] * rng.uniform(0.2, 3, 300)[:, None] + 0.1 * rng.normal(size=(300, 12))
    v[50:90] = v[50]  # copies
    v[7] = 0
    v[11] = v[13] = -v[50]
    rows = [(i, int(rng.integers(0, 3)), v[i].tolist()) for i in range(300)]
    got = mined(spark, rows, shard_rows=shard_rows, references=references)
    assert got == naive_negatives(rows, lambda i: i % 10 == 0) and len(got) > 300


def test_bounds_hold_every_score():
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.normal(size=(400, 8)), rng.normal(size=(3, 8)) * 1e-3, np.zeros((1, 8)), np.full((1, 8), 1e200)])
    v = np.concatenate([v, v[:50], -v[:50], v[:50] * 7])
    refs = hardneg.directions(v[:100])
    size, at = hardneg.angles(v, refs)
    lower, upper = hardneg.interval(size, at, size, size, at, at, 8)
    exact = hardneg.products(v[:404], v[:404])
    assert (lower[:404, :404] <= exact).all() and (exact <= upper[:404, :404]).all()
    assert (upper[404] == np.inf).all() and (lower[:, 404] == -np.inf).all()
    cuts = np.arange(0, 404, 10)
    ends = [f(x[:404], cuts, axis=0) for x in (size, at) for f in (np.minimum.reduceat, np.maximum.reduceat)]
    low, high = hardneg.interval(size[:404], at[:404], *ends, 8)
    group = np.arange(404) // 10
    assert (low[:, group] <= exact).all() and (exact <= high[:, group]).all()


def test_negatives_of_large_numbers(spark):
    rng = random.Random(2)
    rows = [(i, i % 2, [rng.choice([1.0, 1e6, 3e12, -2e9, 1e300, 1 / 3]) for _ in range(3)]) for i in range(60)]
    assert mined(spark, rows) == naive_negatives(rows, lambda i: i % 10 == 0)


def test_negatives_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.9, 0.0]), (2, 2, [0.9, 0.0]), (3, 2, [2.0, 0.0]), (10, 3, [-1.0, 0.0]), (0, 2, [0.95, 0.0]),
        (20, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (4, 2, None), (5, 2, [nan, 1.0]), (6, 2, [inf, 0.0]), (7, 2, [None, 1.0]), (8, 2, [0.9]), (9, 2, []),
    ]
    got = mined(spark, rows)
    fine = rows[:7]
    assert got == naive_negatives(fine, lambda i: i % 10 == 0) and (0, 1, 1, 2, 65536, 58880) in got and len(got) == 2
    assert mined(spark, rows[:1]) == []
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hardneg.mine(empty, F.col("vec_id") % 10 == 0).count() == 0


# -- line frequency ----------------------------------------------------------

_WORD = re.compile("[^\x20\x09-\x0d]+")


def naive_lines(rows, min_docs, max_share, least_left):
    """rows: (doc_id, host, text)."""
    def key(line):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in " ".join(_WORD.findall(line)))
        return re.sub("[0-9]+", "0", low)

    docs, sizes = Counter(), Counter()
    for i, host, text in set(rows):
        sizes[host] += 1
        docs.update({(host, key(x)) for x in (text or "").split("\n") if key(x)})
    out = []
    for i, host, text in rows:
        words = _WORD.findall(text or "")
        lines = [x for x in (text or "").split("\n") if _WORD.search(x)]
        grams = list(zip(words, words[1:], words[2:]))
        many = Counter(grams)
        marked = {j + k for j, g in enumerate(grams) if many[g] > 1 for k in range(3)}
        gone = [x for x in lines if docs[host, key(x)] > min_docs and docs[host, key(x)] > max_share * sizes[host]]
        removed = sum(len(_WORD.findall(x)) for x in gone)
        failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
        out.append((
            i, len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>") if text else 0, len(lines) - len(set(lines)), len(marked), removed,
            len(gone), failed, not failed and len(words) - removed >= least_left * len(words)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def pages():
    rng = random.Random(4)
    frame = ["All rights reserved 2019.", "MENU  home | shop", "menu home | shop", "sign In", "x"]
    rows = []
    for i in range(160):
        own = [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(0, 6))]
        mixed = own + rng.sample(frame, rng.randrange(0, 4)) + ["", " \t", " ", "noél\x1cstop"][: rng.randrange(0, 5)]
        rng.shuffle(mixed)
        rows.append((i % 150, rng.choice(["a", "a", "b", None]), "\n".join(mixed + mixed[: rng.randrange(0, 3)])))
    rows += [rows[3]] * 4 + [(500, "a", None), (501, "b", ""), (None, None, "x"), (None, None, "x"), (502, "a", "word " * 90_000), (503, "a", "café \U0001f600 " * 40)]
    rows += [(600 + i, "b", "\n".join(" ".join(f"c{j}x{k}" for k in range(12)) for j in range(6))) for i in range(12)]
    return rows


def test_lines_by_brute_force(spark, pages):
    df = spark.createDataFrame([(*r, "k", 7) for r in pages], "doc_id int, source string, text string, `key` string, hash int").repartition(5)
    for how in ((3, 0.02, 0.3), (0, 0.1, 0.9), (10_000, 0.0, 0.3)):
        got = sorted((tuple(r) for r in linefreq.judge(df, None, *how).collect()), key=str)
        assert got == naive_lines(pages, *how)
    assert linefreq.judge(df.limit(0)).count() == 0
    kept = linefreq.keep_clean(df, None, 3, 0.02, 0.3)
    want = Counter(r[0] for r in naive_lines(pages, 3, 0.02, 0.3) if r[-1])
    assert Counter(r["doc_id"] for r in kept.collect()) == want
    by = {r[0]: r for r in naive_lines(pages, 3, 0.02, 0.3)}
    for r in kept.collect():
        if r["doc_id"] >= 150:
            assert len(_WORD.findall(r["text"])) == by[r["doc_id"]][1] - by[r["doc_id"]][6]


def test_copied_pages_are_depleted(spark, pages):
    df = spark.createDataFrame(pages, "doc_id int, source string, text string")
    found = {r["doc_id"]: r for r in linefreq.judge(df, None, 3, 0.02, 0.3).collect()}
    assert not found[605]["kept"] and not found[605]["base_failed"] and found[605]["n_removed_words"] == found[605]["n_words"]


# -- collocations ------------------------------------------------------------


def naive_phrases(rows, max_words, least, top):
    f, n = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                f.setdefault(lang, Counter()).update(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        many = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in many.items():
            inside = lambda q: len(q) > len(p) and any(q[j:j + len(p)] == p for j in range(len(q) - len(p) + 1))
            if any(inside(q) and 100 * b >= 50 * a for q, b in many.items()):
                continue
            score, k = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top]):
            out.append((lang, rank + 1, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


@pytest.fixture(scope="module")
def chatter():
    rng = random.Random(8)
    words = ["the", "The", "of", "New", "york", "été", "\x00", "a b", "\x1c", "x" * 300, "city", "is", "onhe", "z9"]
    rows = []
    for i in range(250):
        text = "".join(rng.choices(words, weights=range(14, 0, -1))[0] + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "!?"]) for _ in range(rng.randrange(0, 60)))
        rows.append((rng.choice(["en", "en", "en", "fr", None, "und"]), text))
    return rows + [("en", None), ("de", ""), ("de", " .,. "), ("en", "is onhe " * 5000), ("es", "uno dos"), *[("en", "copied line of text.")] * 40]


@pytest.mark.parametrize("flush,size", [(3_000_000, 12_000_000), (200, 500)])
def test_phrases_by_brute_force(spark, monkeypatch, chatter, flush, size):
    monkeypatch.setattr(stripes, "FLUSH_WORDS", flush)
    monkeypatch.setattr(stripes, "BUCKET_BYTES", size)
    df = spark.createDataFrame([(*r, 1, "p") for r in chatter], "lang string, text string, f int, phrase string").repartition(4)
    for words, least, top in ((3, 10, 2000), (4, 3, 50), (2, 10, 5)):
        got = sorted(tuple(r) for r in stripes.collocations(df, words, least, top).collect())
        assert got == naive_phrases(chatter, words, least, top)
    assert stripes.collocations(df.limit(0)).count() == 0


def test_merging_in_steps_counts_the_same():
    rng = np.random.default_rng(1)
    whole, steps = stripes.Merged(1), stripes.Merged(1)
    for i in range(30):
        names = [b"w%d" % j for j in rng.permutation(50)]
        prefix, following = np.arange(10), rng.integers(0, 50, 40)
        args = (names, prefix, np.full(10, 4), following, rng.integers(1, 9, 40))
        whole.add(*args)
        steps.add(*args)
        steps.merge()
    key = lambda m: sorted(zip(map(tuple, m.entries(20)[0]), m.entries(20)[1]))
    assert key(whole) == key(steps) and whole.entries(1)[2] == steps.entries(1)[2]


def test_scores_beyond_64_bits(spark):
    """a, l, r of several billions: counts go in as a table, as no text of that size fits a test."""
    big = 5_000_000_000
    counted = spark.createDataFrame(
        [("en", [], 10 * big), ("en", ["a"], big + 7), ("en", ["b"], big + 9), ("en", ["a", "b"], big + 1)], "lang string, phrase array<string>, f long")
    r = stripes.scored(counted, 10).collect()
    a, left, right = big + 1, big + 7, big + 9
    assert [(x["phrase"], x["score"], x["n"]) for x in r] == [("a b", 1_000_000 * a * a // (left * right), 10 * big)]


@pytest.mark.parametrize("name", ["op11_negatives", "op12_lines", "op13_phrases"])
def test_queries_have_the_columns_asked_for(spark, name):
    want = {
        "op11_negatives": {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"},
        "op12_lines": {"doc_id": "bigint", **dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), "bigint"), "base_failed": "boolean", "kept": "boolean"},
        "op13_phrases": {"lang": "string", "rank": "bigint", "phrase": "string", **dict.fromkeys(("a", "l", "r", "n", "score"), "bigint")},
    }[name]
    got = dict(llm.QUERIES[name](spark, SF_DIR).dtypes)
    assert want.items() <= got.items() and name in llm.ORACLE


def test_neighbours_in_double_precision(spark):
    rows = [(100, [100000001.0, 0.0]), (1, [100000002.0, 0.0]), (2, [100000003.0, 0.0]), (3, [1e300, 1.0]), (4, [0.1, 0.2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in ann.search(df, F.col("vec_id") % 100 == 0).collect())
    far = math.hypot(100000001.0 - 0.1, 0.2)
    assert [r[:3] for r in got] == [(100, 1, 1), (100, 2, 2), (100, 3, 4), (100, 4, 3)]
    assert [r[3] for r in got[:2]] == [1.0, 2.0] and got[2][3] == pytest.approx(far, rel=1e-15) and got[3][3] == math.inf
