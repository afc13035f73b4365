"""Stored term table and vector partitions: what a query reads, what an update rewrites, what a second run does."""

import math
import shutil
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotlens import session
from lotlens.operators import search, terms, vectors


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(f"d{i}", " ".join(f"w{j}" for j in range(i % 40)) + (" Rumah rumah" if i % 3 == 0 else "") + " é" * (i % 2)) for i in range(200)]
    return spark.createDataFrame([*rows, ("empty", ""), ("none", None)], "id string, content string").repartition(4)


@pytest.fixture(scope="module")
def table(docs, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("terms") / "t")
    terms.build_terms(docs, path, parts=16)
    return path


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def scores(df):
    return {r["id"]: round(r["score"], 9) for r in df.collect()}


def test_same_scores_as_reading_the_texts(spark, docs, table):
    for text in ("rumah w7", "é", "w1 w2 w38", "nothing here", ""):
        want = scores(search.bm25(docs, text, None).select("id", "score")) if search.query_terms(text) else {}
        assert scores(terms.bm25_terms(spark, table, text, None)) == want
    best = terms.bm25_terms(spark, table, "rumah w7", 5).collect()
    assert [r["id"] for r in best] == [r["id"] for r in search.bm25(docs, "rumah w7", 5).collect()]
    some = docs.filter("id < 'd15'")
    assert scores(terms.bm25_terms(spark, table, "rumah w7", None, within=some)) == scores(search.bm25(some, "rumah w7", None))


def test_query_reads_the_partitions_of_its_words_only(spark, table, tmp_path):
    n, words, parts = terms.described(spark, table)
    asked = ["rumah", "w7"]
    plan = terms.postings_of(spark, table, asked, parts)._jdf.queryExecution().toString()
    line = next(x for x in plan.splitlines() if "PartitionFilters" in x)
    assert "part#" in line.split("PartitionFilters")[1].split("]")[0] and "PushedFilters: [In(term" in line
    at = {r["p"] for r in spark.range(1).select(F.explode(F.lit(asked)).alias("t")).select(terms.part_of("t", parts).alias("p")).collect()}
    for folder in ("stats", *(f"postings/part={p}" for p in at)):
        shutil.copytree(f"{table}/{folder}", tmp_path / folder)
    assert scores(terms.bm25_terms(spark, str(tmp_path), "rumah w7", None)) == scores(terms.bm25_terms(spark, table, "rumah w7", None))


def test_update_rewrites_touched_partitions_only(spark, docs, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    terms.build_terms(docs, path, parts=16)
    before = files(path)
    assert terms.update_terms(docs, path) == 0 and files(f"{path}/postings") == {k[9:]: v for k, v in before.items() if k.startswith("postings")}
    now = spark.createDataFrame([("d1", "w7 baru"), ("fresh", "rumah"), ("d2", "w0 w1 é"[:5])], "id string, content string")
    changed = docs.join(now.select("id"), "id", "left_anti").union(now).filter("id <> 'd4'")
    # the first attempt fails after the postings are written
    real = terms.replace_parts

    def fails(df, folder, *rest):
        real(df, folder, *rest)
        raise OSError("lost")

    monkeypatch.setattr(terms, "replace_parts", fails)
    with pytest.raises(OSError):
        terms.update_terms(now, path, docs.filter("id = 'd4'"))
    monkeypatch.setattr(terms, "replace_parts", real)
    rewritten = terms.update_terms(now, path, docs.filter("id = 'd4'"))
    after = files(path)
    kept = [f for f in before if f.startswith("postings") and after.get(f) == before[f]]
    assert 0 < rewritten < 16 and kept
    fresh = str(tmp_path / "fresh")
    terms.build_terms(changed, fresh, parts=16)
    rows = lambda p, t: sorted(map(str, spark.read.parquet(f"{p}/{t}").select("id", "len", *(["term", "tf", "part"] if t == "postings" else ["digest", "slot"])).collect()))
    assert rows(path, "postings") == rows(fresh, "postings") and rows(path, "documents") == rows(fresh, "documents")
    assert terms.described(spark, path) == terms.described(spark, fresh)


def test_recall_and_files_read(spark, tmp_path, sf_dir):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    m = centres[rng.integers(0, 40, 4000)] + 0.35 * rng.normal(size=(4000, 16))
    clustered = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "id long, embedding array<double>")
    given = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    for name, rows, most in (("clustered", clustered, 0.25), ("given", given, 0.9)):
        path = str(tmp_path / name)
        vectors.build_vectors(rows.union(spark.createDataFrame([(-1, None)], "id long, embedding array<double>")), path, cells=32)
        stored = spark.read.parquet(f"{path}/vectors")
        data = {r["id"]: np.array(r["embedding"]) for r in rows.collect()}
        assert sorted(r["id"] for r in stored.select("id").collect()) == sorted(data)
        ids, u = np.array(list(data)), vectors.unit(np.stack(list(data.values())))
        hits, read = 0, 0
        for q in u[:: len(u) // 12][:12]:
            want = ids[np.lexsort((ids, -(u @ q)))[:10]]
            got = [r["id"] for r in vectors.nearest(spark, path, q.tolist(), 10).collect()]
            hits += len(set(want) & set(got))
            read += len(set(map(str, vectors.near_cells(spark, path, q.tolist()).select(F.input_file_name()).distinct().collect())))
        total = len(files(f"{path}/vectors"))
        assert hits >= 0.9 * 120, name
        assert read / 12 <= most * total, name
        plan = vectors.near_cells(spark, path, u[0].tolist())._jdf.queryExecution().toString()
        assert "cell#" in plan.split("PartitionFilters")[1].split("]")[0]


def test_second_run_embeds_nothing(spark, docs, tmp_path):
    path = str(tmp_path / "i")
    ready = docs.withColumn("to_embed", F.concat(F.lit(search.PREFIX), F.coalesce("content", F.lit(""))))
    assert vectors.refresh_index(ready, path, cells=4) == 202
    before = files(f"{path}/terms/postings") | files(f"{path}/vectors/vectors")

    def never(texts):
        raise AssertionError("a text was embedded again")

    assert vectors.refresh_index(ready, path, never, whole=True) == 0
    assert files(f"{path}/terms/postings") | files(f"{path}/vectors/vectors") == before
    new = ready.filter("id <> 'd9'").withColumn("to_embed", F.when(F.col("id") == "d8", F.lit("other words")).otherwise(F.col("to_embed")))
    new = new.withColumn("content", F.when(F.col("id") == "d8", F.lit("other words")).otherwise(F.col("content")))
    seen = []

    def counted(texts):
        assert texts == ["other words"]
        return search.hashed_vectors(texts)

    assert vectors.refresh_index(new, path, counted, whole=True) == 1
    rows = {r["id"]: r["embedding"] for r in spark.read.parquet(f"{path}/vectors/vectors").collect()}
    assert len(rows) == 201 and "d9" not in rows
    want = vectors.unit(search.hashed_vectors(["other words"]))[0]
    assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(rows["d8"], want))
    hits = vectors.nearest(spark, f"{path}/vectors", want.tolist(), 1).collect()
    assert hits[0]["id"] == "d8" and not seen


def test_postings_of_one_file_are_counted_by_all_tasks(spark, tmp_path):
    """Texts of one file are dealt by id, and that is the only shuffle before postings are stored."""
    spark.range(40).selectExpr("id AS doc_id", "concat('red house ', id % 3) AS text").coalesce(1).write.parquet(str(tmp_path / "d"))
    postings, _ = terms._analysed(spark.read.parquet(str(tmp_path / "d")), "doc_id", "text", 8)
    plan = postings._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(id" in plan
    assert postings.count() == 120


def test_keywords_get_ids_that_are_joined_once(spark):
    """With images the ids that count are a stored table: what reads them does not join the documents again."""
    docs = spark.createDataFrame([("a", None, "red house", [1.0, 0.0]), ("b", "a", "red", None), ("c", None, "red", [0.0, 1.0])], "id string, parent_id string, content string, embedding array<double>")
    plans = []

    def keywords(text, k, within):
        plans.append(within._jdf.queryExecution().optimizedPlan().toString())
        return within.select("id", F.lit(1.0).alias("score"))

    got = search.hybrid_search(docs, "red", [1.0, 0.0], images=spark.createDataFrame([("a",), ("b",)], "parent_id string"), keywords=keywords)
    assert sorted((r.id, r.source) for r in got.collect()) == [("a", "bm25"), ("a", "embedding"), ("b", "bm25")]
    assert "Join" not in plans[0]


def test_only_texts_and_vectors_go_to_python(spark):
    """Other columns do not pass through the workers, and a filter on the vector does not run the model again."""
    docs = spark.createDataFrame([(1, "rumah baru", "a"), (2, None, "b"), (3, "taman", None)], "id long, to_embed string, other string")
    made = search.embed(docs, "to_embed")
    want = search.hashed_vectors(["rumah baru", None, "taman"])
    want /= np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-12)
    got = made.orderBy("id").collect()
    assert np.allclose([r.embedding for r in got], want) and [r.other for r in got] == ["a", "b", None]
    placed = vectors.assigned(made, vectors.unit(np.eye(64)[:5]))
    assert [r.cell for r in placed.orderBy("id").collect()] == list((vectors.unit(want) @ np.eye(64)[:5].T).argmax(axis=1))
    plan = placed.filter("size(embedding) > 0")._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" not in plan and plan.count("ArrowEvalPython [") == 2


def test_the_index_job_leaves_no_copies(spark, docs, tmp_path, monkeypatch):
    ready = docs.withColumn("to_embed", F.coalesce("content", F.lit("")))
    base = tmp_path / "shared"
    base.mkdir()
    monkeypatch.setattr(session, "shared_folder", lambda _: str(base))
    seen, real = [], terms.store_parts

    def watched(df, path, *rest):
        real(df, path, *rest)
        # copies of content that lie beside the index while a part of it is stored
        seen.append(sum("content" in spark.read.parquet(str(p)).columns for p in base.iterdir() if list(p.rglob("*.parquet"))))

    monkeypatch.setattr(terms, "store_parts", watched)
    monkeypatch.setattr(vectors, "store_parts", watched)
    assert vectors.refresh_index(ready, str(tmp_path / "i"), cells=4) == 202
    changed = ready.withColumn("content", F.when(F.col("id") == "d5", "baru").otherwise(F.col("content"))).filter("id <> 'd6'")
    assert vectors.refresh_index(changed, str(tmp_path / "i"), cells=4, whole=True) == 1
    left = [spark.read.parquet(str(p)).columns for p in base.iterdir()]
    assert all(c == ["n", "words", "parts"] for c in left) and max(seen) <= 2
    rows = {r["id"]: r["content"] for r in spark.read.parquet(str(tmp_path / "i/vectors/vectors")).collect()}
    assert len(rows) == 201 and rows["d5"] == "baru" and rows["none"] is None
