"""Learned operators against naive forms of their methods, planted decoys and long rule lists."""

import hashlib
import math
import random

import numpy as np
from pyspark.sql import functions as F

from lotlens.llm import pii, quality, toxicity, urls
from lotlens.llm.common import labelled
from tests.conftest import SF_DIR


def with_check_digit(body: str) -> str:
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


def test_decoys_are_refused(spark):
    rng = random.Random(8)
    texts, secrets, decoys = [], {}, {}
    for i in range(400):
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        good = with_check_digit(body)
        bad = body + str((int(good[-1]) + rng.randrange(1, 10)) % 10)
        key = hashlib.sha1(str(i).encode()).hexdigest()
        other = with_check_digit("5" + body[1:])
        kind = i % 5
        text, value = [
            (f"pay with {good} today", None),
            (f"order {bad} was sent", bad),
            (f"token = {key} is mine", key),
            (f"cards {good} {other} both", f"{good} {other}"),
            (f"write to some{i}@gmail.com or +49 30 {rng.randrange(10**6, 10**7)}", None),
        ][kind]
        texts.append((i, text))
        if value:
            (decoys if kind == 1 else secrets)[i] = (text.index(value), text.index(value) + len(value))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    added = {r["doc_id"]: {tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.split(":")[0] in pii.ADDED} for r in pii.find(df, pii.fit(df)).collect()}
    assert all(not added[i] for i in decoys)
    assert all(span in added[i] for i, span in secrets.items())


def test_votes_read_the_whole_span():
    cards = " ".join(with_check_digit(f"4{n:014d}") for n in range(9))
    spoiled = " ".join(c[:-1] + str((int(c[-1]) + 1) % 10) for c in cards.split())
    checksum = pii.LABELERS.index("checksum")
    assert pii.votes(cards, "number", 0, len(cards))[checksum] == 1
    assert pii.votes(spoiled, "number", 0, len(spoiled))[checksum] == -1
    assert pii.votes(spoiled + cards[-17:], "number", 0, len(spoiled) + 17)[checksum] == 1


def test_composed_machine_is_its_machines_in_a_row():
    machines = (toxicity.NEGATION, toxicity.QUOTATION, toxicity.TARGET, toxicity.THREAT, toxicity.INSULT)
    rng = random.Random(5)
    for _ in range(3000):
        state, states = 0, [0] * len(machines)
        for symbol in rng.choices("IHTNRQO", k=rng.randrange(1, 25)):
            state, out, weight = toxicity.GRAMMAR.step(state, symbol)
            total, seen = 0.0, symbol
            for i, m in enumerate(machines):
                if (states[i], seen) in m.arcs:
                    states[i], seen, w = m.arcs[states[i], seen]
                    total += w
                else:
                    states[i] = m.idle.get(states[i], states[i])
            assert (out, weight) == (seen, total)


def naive_features(g: toxicity.Grammar, text: str) -> list[float]:
    """The features clause by clause, the machines one after another."""
    machines = (toxicity.NEGATION, toxicity.QUOTATION, toxicity.TARGET, toxicity.THREAT, toxicity.INSULT)
    sums, clauses, words = {}, [], {}
    clause, states = None, [0] * len(machines)
    for token in [*toxicity.TOKEN.findall(text.lower()), "."]:
        if token in ".;:!?\n":
            clauses += [clause] if clause is not None else []
            clause, states = None, [0] * len(machines)
            continue
        strength = max([0.0] + [w for k, w in g.lexicon.items() if k == "=" + token or len(k) in toxicity.STEM_LENGTHS and k[0] != "=" and token.startswith(k)])
        if strength or toxicity.FIXED.get(token) == "H":
            words[token] = strength
        symbol = "I" if strength else toxicity.FIXED.get(token) or ("Q" if token in "\"“”«»" else "O")
        total = 0.0
        for i, m in enumerate(machines):
            states[i], symbol, w = m.step(states[i], symbol)
            total += w
        if total:
            clause = (clause or 0.0) + total * (strength or toxicity.SEED_WEIGHT)
        sums[symbol] = sums.get(symbol, 0.0) + (strength or toxicity.SEED_WEIGHT)
    if not words:
        return [0.0] * len(toxicity.FEATURES)
    at = [sums.get(s, 0.0) for s in "IAnr"] + [sums.get("H", 0.0) + sums.get("D", 0.0), max(clauses, default=0.0), sum(clauses), sum(words.values())]
    return [math.log1p(x) for x in at]


def test_toxic_features_and_scores_by_brute_force(spark):
    where = SF_DIR
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    rows = docs.select("doc_id", "text").orderBy(F.xxhash64("doc_id")).limit(60).collect()
    odd = ['you idiot. he said " you moron " ; not an idiot! kill you', "idiot", "", "kill", "No idiot\nyou, you idiot idiot"]
    for text in [r["text"] or "" for r in rows] + odd:
        assert np.allclose(model.features(text), naive_features(model, text))
    for r in rows:
        z = float(np.dot(naive_features(model, r["text"] or ""), model.coef) + model.intercept)
        assert math.isclose(got[r["doc_id"]], 1 / (1 + math.exp(-z)), abs_tol=1e-9)


def test_discriminant_is_the_textbook_one(spark):
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    sample = labelled(docs, labels, "quality", quality.FIT_ROWS).collect()
    x = np.array([quality.statistics(r["text"]) for r in sample])
    y = np.array([r["y"] for r in sample])
    probe = x[:200]
    density = []
    for c in (0, 1):
        own = x[y == c]
        mean = own.mean(axis=0)
        cov = sum(np.outer(v - mean, v - mean) for v in own) / len(own)
        diagonal = np.diag(np.maximum(np.diag(cov), 1e-3))
        cov = (1 - quality.SHRINKAGE) * cov + quality.SHRINKAGE * diagonal + 1e-3 * np.eye(len(mean))
        away = probe - mean
        density.append(-0.5 * (np.einsum("ni,ij,nj->n", away, np.linalg.inv(cov), away) + np.linalg.slogdet(cov)[1]))
    want = density[1] - density[0]
    assert np.allclose(model.difference(probe), want, rtol=1e-6, atol=1e-6)
    z = np.sign(want) * np.log1p(np.abs(want))
    assert np.allclose(model.scores([r["text"] for r in sample[:200]]), 1 / (1 + np.exp(-(model.slope * z + model.offset))), atol=1e-6)


def test_long_rule_lists(spark):
    rules = spark.range(60_000).select(F.format_string("h%d.example.org", "id").alias("host"), F.lit("/").alias("path"), F.when(F.col("id") % 3 == 0, "allow").otherwise("block").alias("verdict"))
    pages = spark.range(80_000).select(F.col("id").alias("page_id"), F.format_string("http://h%d.example.org/x", "id").alias("url"))
    got = urls.judge(pages, rules)
    listed = (F.col("page_id") < 60_000)
    want = F.when(listed & (F.col("page_id") % 3 != 0), "block").otherwise("allow")
    assert got.filter((F.col("verdict") != want) | (F.col("rule").isNotNull() != listed)).count() == 0
