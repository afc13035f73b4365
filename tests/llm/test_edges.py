"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest

import corpus_pipeline
from lotlens.llm import ann, chat, decontaminate, neardup, packing, pii, quality, repeats, simhash, toxicity, urls
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, node string, score string, `key` string, spans string, bucket string"
WORDS = " ".join(f"word{i}" for i in range(400))
BIG = 2**62 + 1
TEXTS = [
    (1, WORDS), (2, WORDS), (2, WORDS), (3, None), (4, ""), (None, None), (None, "mail ab@cd.co now"), (5, "x" * 300_000), (6, "é" * 1000 + " \U0001f600 ß"),
    (7, "you idiot! you worthless scum"), (BIG, "call +1 (555) 555-1234 or 10.0.0.1"), (8, " \t\n"), (9, "a b"), (10, WORDS.replace("word17 ", "other ")),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", None, len(t or ""), "x", "y", "z", "k", "s", "b") for i, t in TEXTS], DOCS).repartition(3)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i == 7)) for i in range(1, 11)] + [(7, 0, 1), (None, 1, 1), (11, None, None), (BIG, 1, 7)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, " ".join(WORDS.split()[20:40]), "u"), (2, None, "u"), (3, "", "u"), (4, "a b", "u"), (None, "nowhere to be found at all", "u"), (1, " ".join(WORDS.split()[20:40]), "u")], "item_id long, text string, doc_id string")


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda i: (i is None, i))


ALL = sorted((i for i, _ in TEXTS), key=lambda i: (i is None, i))
PER_ROW = {
    "pii": lambda d, lab: pii.find(d, pii.fit(d)),
    "quality": lambda d, lab: quality.score(d, quality.fit(d, lab)),
    "toxicity": lambda d, lab: toxicity.score(d, toxicity.fit(d, lab)),
    "simhash": lambda d, lab: simhash.components(d),
    "repeats": lambda d, lab: repeats.remove(d),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_per_row(docs, labels, name):
    assert ids(PER_ROW[name](docs, labels)) == ALL
    assert PER_ROW[name](docs.limit(0), labels.limit(0)).count() == 0
    assert PER_ROW[name](docs.limit(0), labels).count() == 0


def test_without_labels(docs, labels):
    assert ids(quality.score(docs, quality.fit(docs, labels.limit(0)))) == ALL
    found = {r["doc_id"]: r["predicted"] for r in toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).collect()}
    assert found[7] == 1 and found[1] == 0


def test_exact_values(docs):
    found = {r["doc_id"]: r for r in pii.find(docs, pii.fit(docs)).collect()}
    assert (found[BIG]["n_phone"], found[BIG]["n_ip"]) == (1, 1)
    assert found[None]["n_email"] in (0, 1)
    rows = {r["doc_id"]: r for r in simhash.components(docs).collect()}
    assert rows[3]["fp"] == rows[4]["fp"] == rows[8]["fp"] == 0 and rows[8]["component_id"] == 3
    assert rows[2]["component_id"] == 1
    kept = {r["doc_id"]: r for r in repeats.remove(docs).collect()}
    assert kept[2]["n_removed"] == len(WORDS) and kept[4]["n_removed"] == 0 and kept[5]["n_removed"] == 300_000


def test_packing(docs):
    rows = packing.pack(docs).collect()
    assert sum(r["start"] == 0 for r in rows) == len(TEXTS)
    by = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert by.get(r["sequence_id"], 0) == r["offset"]
        by[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(by.values()) <= 4096
    assert packing.pack(docs.limit(0)).count() == 0


def test_decontaminate(docs, benchmark):
    found = sorted((r["doc_id"], r["item_id"]) for r in decontaminate.contained(docs, benchmark).collect())
    assert found == sorted([(i, 1) for i in (1, 2, 2, 10)] * 2 + [(9, 4)])
    assert decontaminate.contained(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.contained(docs.limit(0), benchmark).count() == 0


def test_pipeline_stages(spark, docs, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for rows in (docs, docs.limit(0)):
        at = rows
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, at, str(tmp_path))
            if i + 1 < len(corpus_pipeline.STAGES):
                assert out.schema.simpleString() == docs.schema.simpleString(), name
            out.write.parquet(f"{tmp_path}/{rows is docs}{i}")
            at = spark.read.parquet(f"{tmp_path}/{rows is docs}{i}")
    kept = ids(spark.read.parquet(f"{tmp_path}/True1"))
    assert kept == [1, 3, 5, 6, 9, BIG, None]  # 7 is toxic; copies, near copies and texts without words go
    assert ids(spark.read.parquet(f"{tmp_path}/True2")) == [3, 5, 6, BIG, None]
    hidden = {r["doc_id"]: r for r in spark.read.parquet(f"{tmp_path}/True3").collect()}
    assert hidden[BIG]["text"] == "call [PHONE] or [IP]" and hidden[BIG]["n_chars"] == 20
    assert hidden[None]["text"] == "mail [EMAIL] now" and hidden[3]["text"] is None


def test_chat(spark):
    rows = [
        (1, 0, "user", "hi", 0), (1, 1, "bot", "yes", 0),
        (2, 0, "user", "hi", 0), (3, 0, "user", "hi", 0), (3, 5, "bot", "yes", 0), (3, 6, None, None, 0),
        (4, None, None, None, 0), (5, 0, "user", "hi", 0), (5, 0, "user", "hi", 0), (None, 0, "user", "hi", 0), (6, 2000, "a", "b", 0), (6, 3, "c", "", 0),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, `key` int")
    got = sorted((tuple(r)[:2] for r in chat.maximal(turns).select("conv_id", "turn_no", "role").collect()))
    assert got == [(3, 0), (3, 1), (3, 2), (4, 0), (5, 0), (5, 1), (6, 0), (6, 1)]
    by = {}
    for r in sorted(chat.maximal(turns).collect(), key=lambda r: (r["conv_id"], r["turn_no"])):
        assert r["offset"] == by.get(r["conv_id"], 0)
        by[r["conv_id"]] = r["offset"] + len(r["segment"])
    assert chat.maximal(turns.limit(0)).count() == 0


def test_urls(spark):
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow")], "host string, path string, verdict string")
    pages = spark.createDataFrame(
        [(1, "http://A.NET/x"), (2, "http://a.net"), (3, None), (4, "no scheme"), (5, "ftp://example.net/en/?q#f"), (5, "ftp://example.net/en/?q#f"), (None, "x://notexample.net/en/"), (7, "://" + "a." * 5000 + "net/")],
        "page_id long, url string").withColumns({"host": F.lit("h"), "key": F.lit(1), "rule": F.lit(2)})
    got = {r["page_id"]: (r["host"][:12], r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, rules).collect()}
    assert got[1] == ("a.net", "/x", "net/", "block") and got[2] == ("a.net", "", None, "allow")
    assert got[3] == got[4] == ("", "", None, "allow") and got[5] == ("example.net", "/en/", "example.net/en/", "allow")
    assert got[None][2:] == ("net/", "block") and got[7][2:] == ("net/", "block")
    assert urls.judge(pages, rules).count() == 8
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in urls.judge(pages, rules.limit(0)).collect()} == {"allow"}


def test_ann(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (200, []), (300, [2.0, 0.0])]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, v string")
    got = sorted(tuple(r) for r in ann.search(vectors, F.col("vec_id") % 100 == 0, k=3).collect())
    assert got == [(100, 1, 1, 0.0), (100, 2, 2, 0.0), (100, 3, 300, 1.0), (300, 1, 1, 1.0), (300, 2, 2, 1.0), (300, 3, 100, 1.0)]
    assert ann.search(vectors.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_near_duplicates_keep_dissimilar(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(60))) for i in range(20)] + [(None, "w"), (None, "w")], "doc_id long, text string")
    assert neardup.deduplicate(docs).count() == 21
