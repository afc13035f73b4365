"""Methods against brute force, round trips and held-out accuracy on the small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

import public_tokenizers
from lotlens.llm import ann, decontaminate, neardup, packing, pii, quality, repeats, simhash, toxicity, urls
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


def naive_fp(text):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    s = [" ".join(w[j:j + 3]) for j in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_fingerprints_and_components(docs, texts):
    fps = {i: naive_fp(t) for i, t in texts.items()}
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r["doc_id"]: (r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.components(docs).collect()}
    assert got == {i: (fps[i], find(i)) for i in ids}


@pytest.mark.parametrize("crowd", [4096, 3])
def test_links_of_crowded_groups(spark, monkeypatch, crowd):
    monkeypatch.setattr(simhash, "GROUP_ROWS", crowd)
    rng = random.Random(3)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for f in list(fps)[:60]:
        for _ in range(4):
            fps.add(f ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    fps = sorted(np.array(sorted(fps), dtype=np.uint64).view(np.int64).tolist())
    got = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()

    def parts(pairs):
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return [find(f) for f in fps]

    u = np.array(fps).view(np.uint64)
    true = [(fps[i], fps[j]) for i in range(len(u)) for j in np.flatnonzero(np.bitwise_count(u ^ u[i]) <= 2)]
    assert parts([tuple(r) for r in got]) == parts(true)


def test_gray_order_and_pruning():
    fp = np.array([random.Random(1).getrandbits(64) for _ in range(500)], dtype=np.uint64)
    fp[250:] = fp[:250] ^ np.uint64(5)
    pairs = {(int(a), int(b)) for q, m in simhash.GrayIndex(fp).within(fp, 24) for a, b in zip(q, m)}
    want = {(i, int(j)) for i in range(500) for j in np.flatnonzero(np.bitwise_count(fp ^ fp[i]) <= 24)}
    assert pairs == want
    assert simhash.gray_rank(np.array([b ^ (b >> 1) for b in range(64)], dtype=np.uint64)).tolist() == list(range(64))


def test_near_duplicates(spark, monkeypatch):
    rng = random.Random(9)
    rows, groups = [], []
    for g in range(12):
        base = [f"v{rng.randrange(10**6)}" for _ in range(rng.choice([30, 120, 300]))]
        n = rng.choice([2, 5, 40])
        members = []
        for _ in range(n):
            w = list(base)
            for _ in range(len(w) // 100):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10**6)}"
            members.append(" ".join(w))
        groups.append(range(len(rows), len(rows) + n))
        rows += members
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = neardup.shingle_hashes(rows)
    left = set(range(len(rows)))
    for g in groups:
        root = {i: i for i in g}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i in g:
            for j in g:
                if i < j and neardup.similar(sets[i], sets[j]):
                    x, y = sorted((find(i), find(j)))
                    root[y] = x
        left -= {i for i in g if find(i) != i}
    assert {r["doc_id"] for r in neardup.deduplicate(df).collect()} == left
    monkeypatch.setattr(neardup, "CLUSTER_ROWS", 16)
    crowded = {r["doc_id"] for r in neardup.deduplicate(df).collect()}
    assert left <= crowded and len(crowded) <= len(left) + 2


def test_near_duplicates_of_equal_shingles(spark):
    """Punctuation and repeats change no shingle set, but a fingerprint of whitespace words by far more than 20 bits."""
    rng = random.Random(4)
    rows = []
    for _ in range(4):
        base = [f"v{rng.randrange(10**6)}" for _ in range(200)]
        for share in (0, 0.1, 0.2, 0.3, 0.5, 1):
            rows.append(" ".join(w + rng.choice(",.;!?") if rng.random() < share else w for w in base))
        block = [f"v{rng.randrange(10**6)}" for _ in range(60)]
        rows += [" ".join([*base, *block * k]) for k in (2, 9, 40)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in neardup.deduplicate(df).collect()) == [i for i in range(len(rows)) if i % 9 in (0, 6)]


def test_near_duplicates_of_a_large_cluster(spark, monkeypatch):
    """Pairs of texts that share a template: one cluster, whose orders are cut into many short pieces."""
    rng = random.Random(6)
    template = [f"t{i}" for i in range(130)]
    rows = []
    for _ in range(110):
        own = template + [f"v{rng.randrange(10**6)}" for _ in range(170)]
        near = list(own)
        for k in rng.sample(range(130, 300), 6):
            near[k] = f"z{rng.randrange(10**6)}"
        rows += [" ".join(own), " ".join(near)]
    sets = neardup.shingle_hashes(rows)
    left = {i for i in range(len(rows)) if not any(neardup.similar(sets[i], sets[j]) for j in range(i))}
    assert len(left) < 150
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    monkeypatch.setattr(neardup, "CLUSTER_ROWS", 16)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        assert {r["doc_id"] for r in neardup.deduplicate(df).collect()} == left
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("seed", range(3))
def test_connected_is_brute_force(seed):
    rng = np.random.default_rng(seed)
    base = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (5, 40, 40, 200)]
    sets = [b[rng.random(len(b)) < 0.93] for b in base for _ in range(25)] + [base[0][:0]] * 3
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if neardup.similar(sets[i], sets[j]):
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    assert neardup.connected(sets).tolist() == root


def test_base_spans(texts):
    rng = random.Random(2)
    odd = ["".join(rng.choice("ab@.-+ 0123456789()%\n") for _ in range(rng.randrange(80))) for _ in range(4000)]
    luhn = pii.luhn
    assert luhn("4539578763621486") and not luhn("4539578763621487")
    for t in [*texts.values(), *odd, "a@b@c.de", "1.2.3.4.5.6.7.8", "1" * 5000 + ".1.1.1", "+1 +22222222", "@x.y", "a@b.c@d.e"]:
        want = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        want += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m.group().split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
            d = re.sub("[ -]", "", m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                want.append(("card", *m.span()))
        want += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]
        assert pii.base_spans(t) == want


def test_added_spans(spark):
    texts = [f'{i} token = "{hashlib.sha1(str(i).encode()).hexdigest()}" and version 1.2 of page {i}' for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.find(df, pii.fit(df)).collect()
    for r in rows:
        assert len(r["spans"].split(",")) == 1 and r["spans"].startswith("secret:")
        assert r["base_sha256"] == hashlib.sha256(b"").hexdigest()


def test_reliabilities_prefer_agreeing_labelers():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.4
    good = np.stack([np.where(rng.random(len(truth)) < q, truth, ~truth) * 2 - 1 for q in (0.9, 0.85, 0.8, 0.55)], axis=1)
    seen, back, n = np.unique(good, axis=0, return_inverse=True, return_counts=True)
    p = pii.reliabilities(seen, n.astype(float))[back.ravel()]
    assert ((p > 0.5) == truth).mean() > 0.92


def test_tokens_equal_the_tokenizer(texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    whole, words = Tokenizer.from_file(path), packing.WordTokens(path)
    rng = random.Random(5)
    odd = ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 400), 10, 9, 0x1C, 0x85, 0x301, 0x130, 0x3A3])) for _ in range(60)) for _ in range(500)]
    for t in [*texts.values(), *odd, "", "<|endoftext|> x", "it's they'LL 'sx' 12½ ªº", "İstanbul ŉ ſ"]:
        assert np.frombuffer(words.encode(t), dtype="<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_new_words_of_many_texts_are_encoded_together(texts, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(packing.TOKENIZER)
    whole, words, learned = Tokenizer.from_file(path), packing.WordTokens(path), []
    monkeypatch.setattr(packing.WordTokens, "MEMORY", 50)  # words are forgotten before every call
    learn = words._learn
    words._learn = lambda new: (learned.append(len(new)), learn(new))
    some = [*texts.values(), "", "it's they'LL 'sx' 12½", "naïve <|endoftext|>", "Σ x"]
    for part in (some, some[::-1], some[:3]):
        got = [np.frombuffer(x, dtype="<u4").tolist() for x in words.encode_all(part)]
        assert got == [whole.encode(t, add_special_tokens=False).ids for t in part]
    assert len(learned) == 3


def test_packing_round_trip(docs, texts):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packing.pack(docs).collect()}
    want = {}
    for i, t in texts.items():
        ids = np.array([*whole.encode(t, add_special_tokens=False).ids, 1], dtype="<u4")
        for k in range(0, len(ids), 4096):
            want[i, k // 4096] = (k, len(ids[k:k + 4096]), zlib.crc32(ids[k:k + 4096].tobytes()))
    assert got == want


def test_plan_of_a_large_histogram():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(np.clip(rng.lognormal(6.3, 1.0, 400_000).astype(int), 1, 4096), return_counts=True)
    histogram = dict(zip(lengths.tolist(), counts.tolist()))
    rows = packing.plan(histogram)
    total = int((lengths * counts).sum())
    ranges = {}
    for length, rank, sequence, offset in rows.tolist():
        ranges.setdefault(length, []).append(rank)
    assert all(r[0] == 0 for r in ranges.values()) and set(ranges) == set(histogram)
    # lay every piece out as pack does
    used, ends = {}, np.zeros(int(total / 4096 * 1.2) + 2, dtype=np.int64)
    keys = rows[:, 0] * (1 << 44) + rows[:, 1]
    for length, n in histogram.items():
        at = np.searchsorted(keys, length * (1 << 44) + np.arange(n), side="right") - 1
        sequence = rows[at, 2] + np.arange(n) - rows[at, 1]
        np.add.at(ends, sequence, length)
        used[length] = sequence.max()
    sequences = max(used.values()) + 1
    assert ends.max() <= 4096 and sequences <= total / 4096 * 1.005 + 2


def test_containment_search(docs, texts, spark):
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    items = {r["item_id"]: decontaminate.shingle_set(decontaminate.words_of(r["text"]), 5) for r in bench.collect()}
    want = {}
    for i, t in texts.items():
        own = decontaminate.shingle_set(decontaminate.words_of(t), 5)
        for k, s in items.items():
            if len(own & s) >= 0.8 * len(s):
                want[i, k] = len(own & s) / len(s)
    got = {(r["doc_id"], r["item_id"]): r["containment"] for r in decontaminate.contained(docs, bench).collect()}
    assert want and got == pytest.approx(want)


def test_sketch_misses_nothing():
    rng = random.Random(8)
    items = [(k, " ".join(f"t{rng.randrange(5000)}" for _ in range(rng.randrange(5, 80)))) for k in range(200)]
    index = decontaminate.ItemIndex(items)
    texts, want = [], set()
    for n, (k, t) in enumerate(items):
        w = t.split()
        drop = rng.randrange(len(w))
        texts.append(" ".join(["q"] * 300 + w[:drop] + ["changed"] + w[drop + 1:] + ["r"] * 300))
        a, b = decontaminate.shingle_set(w, 5), decontaminate.shingle_set(texts[-1].split(), 5)
        if len(a & b) >= 0.8 * len(a):
            want.add((n, k))
    got = {(d, index.items[i]) for d, i, _ in index.search(texts)}
    assert want <= got and want


def auc(score, y):
    r = pd.Series(score).rank().to_numpy()
    n1 = y.sum()
    return (r[y == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(y) - n1))


@pytest.mark.parametrize("module, column, floor", [(quality, "quality", 0.97), (toxicity, "toxic", 0.8)])
def test_held_out_accuracy(spark, module, column, floor):
    where = SF_DIR.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    rows = module.score(docs, module.fit(docs, labels)).filter("held_out").join(labels, "doc_id").toPandas()
    assert all(zlib.crc32(str(i).encode()) % 4 == 2 for i in rows["doc_id"])
    assert auc(rows["score"].to_numpy(), rows[column].to_numpy()) >= floor


def test_grammar_tells_reported_and_negated_clauses():
    g = toxicity.PRIOR
    plain, aimed = g.features("what an idiot"), g.features("you idiot")
    negated, reported = g.features("he is not an idiot"), g.features('she said " idiot "')
    names = toxicity.FEATURES
    assert plain[names.index("plain")] and aimed[names.index("aimed")] and negated[names.index("negated")] and reported[names.index("reported")]
    assert aimed[names.index("best_clause")] > plain[names.index("best_clause")] > negated[names.index("best_clause")]
    assert g.features("clean words only") == [0.0] * len(names)


def brute(texts, length):
    seen = {}
    for i, t in enumerate(texts):
        for j in range(len(t) - length + 1):
            seen.setdefault(t[j:j + length], []).append((i, j))
    cover = [bytearray(len(t)) for t in texts]
    for where in seen.values():
        if len(where) > 1:
            for i, j in where:
                cover[i][j:j + length] = b"\1" * length
    out = []
    for t, c in zip(texts, cover):
        kept = bytes(x for x, y in zip(t, c) if not y)
        out.append((len(t), sum(c), sum(1 for k in range(len(c)) if c[k] and not (k and c[k - 1])), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("crowd", [2000, 1])
def test_repeats(spark, monkeypatch, crowd):
    monkeypatch.setattr(repeats, "CROWD", crowd)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 3000)
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh é") for _ in range(rng.randrange(900))) for _ in range(25)]
    texts = [*base, "a" * 9000, "ab" * 600 + "c" + "ab" * 300, base[3]]
    for _ in range(30):
        a, b = rng.choice(base), rng.choice(base)
        t = a[:rng.randrange(len(a) + 1)] + b[rng.randrange(len(b) + 1):]
        texts.append(t[:len(t) // 2] + "Z" + t[len(t) // 2 + 1:] if rng.random() < 0.5 else t)
    got = [tuple(r)[1:] for r in sorted(repeats.remove(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())]
    assert got == brute([t.encode() for t in texts], 200)


def test_matching_statistics():
    rng = random.Random(7)
    for _ in range(60):
        data = np.array([*(rng.choice(b"ab\0") for _ in range(rng.randrange(2, 50))), 255], dtype=np.uint8)
        b, want = data.tobytes(), []
        for i in range(len(b)):
            best = 0
            for j in range(len(b)):
                k = 0
                while i != j and max(i, j) + k < len(b) and b[i + k] == b[j + k]:
                    k += 1
                best = max(best, k)
            want.append(best)
        index = repeats.RunIndex(data)
        assert index.matching_statistics().tolist() == want and index.runs == len(index.heads[0]) <= len(b)


def test_recall(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    rows = vectors.collect()
    ids, v = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], dtype=float)
    got = {}
    for r in ann.search(vectors, F.col("vec_id") % 100 == 0, shard_rows=100).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    hits = total = 0
    for q, found in got.items():
        far = np.sqrt(((v - v[ids == q]) ** 2).sum(axis=1))
        want = sorted((d, i) for d, i in zip(far.tolist(), ids.tolist()) if i != q)[:10]
        assert sorted(found) == list(range(1, 11)) and [found[k] for k in range(1, 11)] == sorted(found.values())
        hits += len({i for _, i in want} & {i for _, i in found.values()})
        total += 10
    assert len(got) == sum(i % 100 == 0 for i in ids.tolist()) and hits / total >= 0.9


def test_cascade_is_exact(spark):
    rng = random.Random(11)
    keys = [(f"k{i}", rng.random() < 0.05) for i in range(5000)]
    universe = spark.createDataFrame(keys, "key string, listed boolean").repartition(4)
    cascade = urls.Cascade(universe)
    assert len(cascade.levels) > 1
    assert universe.filter(cascade.holds(F.col("key")) != F.col("listed")).count() == 0
    none = urls.Cascade(universe.filter("false"))
    assert universe.filter(none.holds(F.col("key"))).count() == 0
