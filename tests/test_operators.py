import datetime
import random
import re

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from lotlens.functions.tails import chi_square_tail, student_two_sided
from lotlens.operators import aggregates as agg
from lotlens.operators.pagetree import Page
from lotlens.operators import extract, features, joins, pagebatch, pricing, quantiles, search, stats
from lotlens.plans.derived import listing_pages


# -- quantiles and positions under skew --------------------------------------

@pytest.mark.parametrize("at_once", [200_000, 3])
def test_quantiles_exact_with_a_hot_group(spark, monkeypatch, at_once):
    """With three values at once every bracket is narrowed, round after round."""
    monkeypatch.setattr(quantiles, "TASK_VALUES", at_once)
    monkeypatch.setattr(quantiles, "SLICES", 16)
    monkeypatch.setattr(quantiles, "ACCURACY", 10_000)
    monkeypatch.setattr(quantiles, "MARGIN", 10 / 10_000)
    rng = np.random.default_rng(3)
    groups = {"hot": rng.normal(size=40_000).round(3), "flat": np.repeat(2.0, 9_000), "wide": np.exp(rng.normal(size=12_000) * 5)}
    data = [(k, float(x)) for k, xs in groups.items() for x in xs] + [("hot", None), (None, 1.0), (None, 4.0), ("one", 7.0), ("none", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    got = {r.k: r for r in quantiles.group_quantiles(df, ["k"], F.col("v"), {"a": 0.25, "b": 0.5, "c": 0.99}, {"n": F.count("v")}).collect()}
    for k, xs in groups.items():
        assert np.allclose([got[k].a, got[k].b, got[k].c], np.quantile(xs, [0.25, 0.5, 0.99]), rtol=1e-12)
        assert got[k].n == len(xs)
    assert (got[None].a, got[None].b) == (1.75, 2.5) and got["one"].c == 7.0 and got["none"].b is None
    for n in range(1, 9):  # the neighbours of a position exist in groups of any size
        few = spark.createDataFrame([(float(x * x),) for x in range(n)], "v double")
        ps = {f"q{i}": i / 20 for i in range(21)}
        assert np.allclose(list(quantiles.group_quantiles(few, [], F.col("v"), ps).first()), np.quantile([x * x for x in range(n)], list(ps.values())))
    one = quantiles.group_quantiles(df.filter("k = 'hot'"), [], F.col("v"), {"m": 0.5}).first()
    assert np.isclose(one.m, np.quantile(groups["hot"], 0.5))


def test_positions_spread_a_hot_group(spark):
    data = [("hot", i) for i in range(3000)] + [("x", i) for i in range(5)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k string, i int")
    got = agg.positions(df, ["k"], ["i"], tasks=6).collect()
    assert all(r.position == r.i + 1 for r in got) and len(got) == 3005


def test_lists_keep_nulls_and_continue_on_pages(spark):
    df = spark.createDataFrame([("a", i, None if i == 1 else str(i)) for i in range(5)], "k string, i int, v string")
    got = {r.page: r["items"] for r in agg.lists_per_key(df, "k", "v", ["i"], page_rows=3).collect()}
    assert got == {0: ["0", None, "2"], 1: ["3", "4"]}


def test_distinct_on_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 3, "z"), ("a", 1, "y"), ("b", 2, None)], "k string, i int, s string")
    one = agg.distinct_on(df, ["k"], ["i"])
    assert sorted(tuple(r) for r in one.collect()) == [("a", 1, "y"), ("b", 2, None)]
    assert "WindowGroupLimit" in one._jdf.queryExecution().executedPlan().toString()


def test_pivot_long_takes_any_number_of_values(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    assert agg.pivot_long(df, "k", "v").count() == 5000


def test_resample_fills_gaps(spark):
    days = [(datetime.datetime(2020, m, 1),) for m in (1, 1, 4, 4, 4)]
    got = agg.resample_month(spark.createDataFrame(days, "t timestamp"), "t", above=-1).orderBy("month").collect()
    assert [r.total for r in got] == [2, 0, 0, 3]


# -- joins -------------------------------------------------------------------

def test_related_tree_with_cycle(spark):
    long = "x" * 60
    rows = [("a", "c", long), ("b", "a", long), ("c", "b", long), ("d", "c", "short"), ("e", "d", long), ("z", None, long)]
    docs = spark.createDataFrame(rows, "id string, parent_id string, content string")
    got = joins.related(docs, docs.filter("id = 'a'").select("id"))
    assert sorted(r.id for r in got.collect()) == ["a", "b", "c", "d", "e"]
    assert joins.related(docs, docs.filter("id = 'none'").select("id")).count() == 0


def test_lookup_duplicates_multiply(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    t = spark.createDataFrame([("a", "A1"), ("a", "A2")], "s string, t string")
    assert sorted(str(r.k) for r in joins.lookup(df, t, "k", "s", "t", "k").collect()) == ["A1", "A2", "None", "b"]


# -- pages -------------------------------------------------------------------

PAGE = """<html><nav><p>m</p><ul><li>Home</li></ul><a title="Beranda" href="/">h</a></nav><div><span>Rp 99 Juta</span><div class="mb-4"><p>P</p><p>9</p></div></div><div class="ui-container"><div><div><span class="p">Rp 1,5 Miliar</span></div><p>Cicilan : <b>Rp 9,8</b> Jutaan</p>
<div><h1>Rumah</h1><p>Cibinong, Bogor</p><p>Diperbarui 7 Agustus 2023 oleh X</p></div><div><p>T</p><ul><li> KPR </li><li>SHM</li></ul></div>
<div><p>Deskripsi</p><p>Bagus &amp; murah</p></div><div><p>Spesifikasi</p><div><div class="a mb-4 b"><p>K</p><p>1</p></div>
<div class="mb-4"><p>K</p><p>2</p></div><div class="mb-4"><p>only</p></div></div></div>
<div id="facility-x"><div>AC</div><p><span> Masjid </span></p><div><p><span>Pool<b>x</b></span></p></div></div></div><div><div class="flex-grow"><div>i</div><a title="Budi " href="/agen/budi">B</a><a href="https://f.id/c" title="Firma">F</a></div></div>
<button name="phone" title="0812">x</button><button name="phone" title="62812">x</button>
<img alt="a" srcset="/i?url=https%3A%2F%2Fc%2Fcustomer%2Fp+1.jpg%26w%3D1&amp;q=2 1x, /i?url=z 2x"/><img alt="map" srcset="/i?url=https%3A%2F%2Fc%2Fcustomer%2Fm 1x, z 2x"/>
</div><div class="promo"><div class="flex-grow"><a title="Iklan" href="/x">I</a></div><p>Promo</p><ul><li>PROMO</li></ul></div></html>"""


def test_page(spark):
    url = "https://www.site.id/properti/bogor/hos1/"
    pages = spark.createDataFrame([(url, PAGE), (url + "perumahan-baru/x", PAGE), ("https://www.site.id/properti/b/hos2", "<html></html>")], "url string, html string")
    got = {r.id: r for r in extract.pages_to_listings(pages).collect()}
    assert sorted(got) == ["hos1", "hos2"]
    p = got["hos1"]
    assert (p.price, p.installment, p.address, p.description) == (1500.0, 9.8, "Cibinong, Bogor", "Bagus & murah")
    assert (p.tags, p.specs, p.facilities) == (["KPR", "SHM"], {"K": "2"}, ["Masjid", "Pool"])
    assert (p.agent.name, p.agent.url, p.agent.phone) == ("Budi", "https://www.site.id/agen/budi", "62812")
    assert (p.agent.company.name, p.agent.company.url) == ("Firma", "https://f.id/c")
    assert p.images == ["https://c/customer/p+1.jpg"] and p.last_modified == "2023-08-07T00:00:00"
    empty = got["hos2"]
    assert (empty.price, empty.agent.name, empty.tags, empty.specs, empty.last_modified) == (None, None, [], {}, None)


def shape(text):
    page = Page(text)
    name = lambda i: f"{page.tag[i]}({''.join(map(name, kids))})" if (kids := [j for j in range(i + 1, page.end[i]) if page.parent[j] == i and page.tag[j]]) else page.tag[i]
    return [name(j) for j in range(1, page.end[0]) if page.parent[j] == 0 and page.tag[j]]


@pytest.mark.parametrize("text,want", [
    ("<div><div>a</div><p>b</p></div><p>", ["div(divp)", "p"]),
    ("<p>a<p>b<div>c</div></p>", ["p", "p", "div"]),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["ul(lili(ul(li))li)"]),
    ("<p><b>a</p><i>b</i>", ["p(b)", "i"]),
    ("<div></p></span><a>x</div></a><b/><br/><a href=/s/>t</a>", ["div(a)", "b", "br", "a"]),
    ("<script>a<div></script><style></p></style><!-- <div> --><DIV>", ["script", "style", "div"]),
    ("<table><tr><td>a<td>b<tr><th>c</table>1 < 2 <", ["table(tr(tdtd)tr(th))"]),
    ("<div title='a>b' class=x>c</div><div", ["div"]), ("", []), ("</div></div>", []),
])
def test_nesting(text, want):
    assert shape(text) == want


def test_deep_page_is_read_once():
    page = Page("<div>" * 20_000 + "x" + "</div>" * 20_000 + "<p a=1 A=2 b c='&lt;'>1 &lt;<!-- --> 2<br>3</p>")
    p = page.within([0], "p")[0]
    assert len(page.within([0, 1, 2], "div")) == 20_000 and page.text(1) == "x"
    assert page.own_texts(p) == ["1 < 2", "3"] and [page.attribute(p, n) for n in "abcd"] == ["1", "", "<", None]


def test_long_paragraph_does_not_overflow(spark):
    text = "kata " * 200_000
    pages = spark.createDataFrame([("https://s/properti/x/h", f"<div class='ui-container'><div><h1>a</h1></div><p>b</p><p>Deskripsi</p><p>{text}</p></div>")], "url string, html string")
    assert extract.pages_to_listings(pages).first().description == text


def test_prices_and_dates(rows):
    assert rows([("Rp 850 Juta",), ("Rp 5",), ("none",), (None,)], "c string", extract.price_in_millions("c")) == [(850.0,), (None,), (None,), (None,)]
    d = datetime.date
    assert rows([("x 7 Agustus 2023",), ("31 Februari 2023",), ("1 May 2020",)], "c string", extract.parse_id_date("c")) == [(d(2023, 8, 7),), (None,), (None,)]


def test_entities(rows):
    texts = {"caf&eacute; &#8211; &#x20AC; ok": "café – € ok", "&amp;lt; &lt;": "&lt; <", "&nosuch; &": "&nosuch; &", "a&#38;#60;": "a&#60;"}
    assert [r[0] for r in rows([(t,) for t in texts], "c string", extract.unescape("c"))] == list(texts.values())


def test_resolve(rows):
    base = "https://h.id/a/b?x=1#f"
    hrefs = {"/c": "https://h.id/c", "c": "https://h.id/a/c", "//o.id/x": "https://o.id/x", "http://z/": "http://z/", "?q": "https://h.id/a/b?q", "#t": "https://h.id/a/b?x=1#t",
             "../d": "https://h.id/d", "./d/../e/": "https://h.id/a/e/", "..": "https://h.id/", "/x/./y/..": "https://h.id/x/", "/q?a=../b": "https://h.id/q?a=../b"}
    got = rows([(base, h) for h in hrefs], "b string, h string", extract.resolve("b", "h"))
    assert [r[0] for r in got] == list(hrefs.values())


# -- statistics --------------------------------------------------------------

def test_pvalue_equals_regression(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=60)
    y = 0.3 * x + rng.normal(size=60)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, price double")
    ours = stats.pearson_table(df).first()
    lr = LinearRegression(featuresCol="f", labelCol="price", solver="normal").fit(VectorAssembler(inputCols=["x"], outputCol="f").transform(df))
    assert abs(ours.pvalue - lr.summary.pValues[0]) < 1e-9
    assert abs(ours.r - np.corrcoef(x, y)[0, 1]) < 1e-12
    assert abs(student_two_sided(2.0, 10) - 0.0733880347707404) < 1e-12


def test_normality_tells_samples_apart(spark):
    rng = np.random.default_rng(2)
    for values, normal in ((rng.normal(size=2000), True), (np.exp(rng.normal(size=2000)), False)):
        r = stats.normality_test(spark.createDataFrame([(float(v),) for v in values], "v double"), "v").first()
        assert r.is_normal == normal and abs(r.pvalue - np.exp(-r.statistic / 2)) < 1e-12


def test_chisq(spark):
    df = spark.createDataFrame([(10.0, 8.0), (20.0, 22.0), (30.0, 30.0)], "o double, e double")
    row = stats.chisq_gof(df, "o", "e").first()
    assert abs(row.statistic - (4 / 8 + 4 / 22)) < 1e-9 and row.dof == 2 and abs(row.pvalue - np.exp(-row.statistic / 2)) < 1e-12
    many = spark.range(20_000).select(F.lit(1.0).alias("o"), F.lit(1.0).alias("e"))
    assert stats.chisq_gof(many, "o", "e").first().pvalue == 1.0
    for x, k, want in ((3.841459, 1, 0.05), (18.307038, 10, 0.05), (124.342113, 100, 0.05), (1.0, 4, 0.9097959895689501)):
        assert abs(chi_square_tail(x, k) - want) < 1e-7
    assert abs(student_two_sided(2.0, 1e12) - 0.04550026389635842) < 1e-9
    assert abs(student_two_sided(2.0, 1001) - student_two_sided(2.0, 1000)) < 1e-6


# -- pages: the quick way of cutting ------------------------------------------

def test_pages_cut_at_plain_tags_have_the_same_elements():
    rng = random.Random(4)
    bits = ["<!--", "-->", "<", ">", "<script>", "</script>", "<style a>", "</STYLE >", "<p", "/>", "'", '"', "<br/>", "<li>", "</ul>", "<!x>", "<?", "< ",
            "</3>", '<a"b>', '<a b=">">', "<!-->", "<td>", "<!---->", "x<!-- a<b>c -->y", "<>", "<!", "<scripty>", "<P>", "text", " ", "<div>", "</div>", "<p>", "</p>"]
    quick = 0
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))
        a, b, c = Page(text), Page(""), Page("")
        b._clear()
        b._whole(text)
        c._clear()
        quick += c._quick(text)
        assert (a.tag, a.parent, a.end, a.value, a._of) == (b.tag, b.parent, b.end, b.value, b._of), text
    assert quick > 100


def _batch(pages):
    coded = [p.encode() for p in pages]
    return b"".join(coded), np.concatenate([[0], np.cumsum([len(c) for c in coded])]).astype(np.int64)


def test_pages_read_many_at_a_time_give_what_each_gives_alone(spark, sf_dir):
    """Pages as rendered, and with tags dropped, doubled, swapped and broken."""
    whole = [r.html for r in listing_pages(spark, sf_dir).limit(60).collect()]
    bits = ["<p>", "</p>", "<div>", "</div>", "<ul>", "<li>", "</ul>", "<b>", "</b>", "<!-- x <p> -->", "<br/>", "<table><tr><td>", "<td/>", "<tr>", "</table>",
            "&am<b>p;</b>", "Cic<i>ilan</i> Rp 3", "R<b>p </b>7", "<my-tag a='1'>", "</my-tag>", '<a title="x>y">', "<a title='q\"q' href=1>",
            '<script>x="<div>"</script>', "<style>p>a{}</style>", "x < y", "a > b", '<div class="ui-container">', "<dl><dt>a<dd>b<dt>c</dl>", "é", "<dïv>", "<?php x ?>",
            "<script>", "<!-- open", "<DIV CLASS='mb-4'>", "<verylongnameofatagthatgoeson>", '">', "</>", "<scripty>", "<x" + "<div>" * 300]
    rng = random.Random(8)

    def broken(page):
        parts = re.split("(<[^>]*>)", page)
        for _ in range(rng.choice([1, 3, 20])):
            k, j = rng.randrange(len(parts)), rng.randrange(len(parts))
            parts[k:k + 1] = rng.choice([[rng.choice(bits), parts[k]], [], [parts[j]]])
            parts = parts or [""]
        return "".join(parts)

    pages = whole + [broken(rng.choice(whole)) for _ in range(1500)] + ["", "x", "<p>", "<div>" * 400]
    odd = pagebatch.Pages(*_batch(pages)).odd
    assert not odd[:60].any() and 100 < (~odd).sum() and odd.sum() > 100
    assert extract.read_pages(*_batch(pages)) == [extract.read_page(p) for p in pages]


def test_plain_pages_take_no_python_step_per_tag(spark, sf_dir, monkeypatch):
    data = _batch([r.html for r in listing_pages(spark, sf_dir).limit(200).collect()])
    monkeypatch.setattr(extract.pagetree, "Page", None)  # the reader of single pages
    assert all(r[0] for r in extract.read_pages(*data, wanted=["price_text"]))


def test_single_fields_equal_those_of_the_whole_page(spark, sf_dir):
    pages = listing_pages(spark, sf_dir).limit(40).cache()
    whole = {r.url: r for r in extract.page_fields(pages).collect()}
    for name in extract.FIELD_NAMES:
        got = extract.page_fields(pages, only=[name])
        assert got.columns == ["url", name] and all(r[name] == whole[r.url][name] for r in got.collect())


# -- model -------------------------------------------------------------------

@pytest.fixture(scope="module")
def model_table(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(1500):
        land, noise, sub = float(rng.uniform(50, 500)), float(rng.normal()), f"area{i % 4}"
        rows.append((f"hos{i}", float(np.log(1e6 * land * (1 + i % 4))), sub, land, None if i % 10 == 0 else noise))
    return spark.createDataFrame(rows, "id string, price double, subdistrict string, luas_tanah double, noise double").cache()


def test_split_is_stable(spark, model_table):
    a, b = features.split(model_table, "id")
    c, _ = features.split(model_table.repartition(7), "id")
    assert {r.id for r in a.collect()} == {r.id for r in c.collect()}
    assert a.count() + b.count() == 1500 and 400 < b.count() < 600


def test_model_learns(spark, model_table, tmp_path):
    train, test = features.split(model_table, "id")
    model = pricing.fit_price_model(train, skip=("id",), maxIter=10, maxDepth=4)
    metrics, residuals = pricing.evaluate(model, test)
    assert metrics.first().r2 > 0.9 and residuals.count() == test.count()
    top = pricing.importances(model).first()
    assert top.feature in ("luas_tanah", "subdistrict")
    folds = pricing.cross_validate(train, "id", k=2, maxIter=3, maxDepth=3)
    assert folds.count() == 2 and pricing.mean_metrics(folds).first().mse > 0
    runs = pricing.search(train, "id", pricing.sample_params(1), k=2, table=str(tmp_path / "runs"), holdout=test)
    assert spark.read.parquet(str(tmp_path / "runs")).count() == runs.count() == 1


def test_halving_keeps_the_best_and_goes_on(spark, model_table, tmp_path, monkeypatch):
    train, test = features.split(model_table, "id")
    good, poor = {"maxIter": 6, "maxDepth": 4, "stepSize": 0.3}, {"maxIter": 1, "maxDepth": 1, "stepSize": 0.01}
    trials = [poor, good, poor | {"stepSize": 0.02}, poor | {"stepSize": 0.03}]
    ask = lambda: pricing.halving(train, "id", trials, str(tmp_path), rungs=2, keep=2, k=2, holdout=test)
    real, calls = pricing.fit_price_model, []

    def stops(*a, **b):
        calls.append(1)
        if len(calls) > 3:
            raise OSError("stopped")
        return real(*a, **b)

    monkeypatch.setattr(pricing, "fit_price_model", stops)
    with pytest.raises(OSError):
        ask()
    stored = spark.read.schema(pricing.RUN).parquet(f"{tmp_path}/runs").count()
    monkeypatch.setattr(pricing, "fit_price_model", real)
    runs = ask().collect()
    assert stored == 3 and [r.place for r in runs] == list(range(1, 7)) and [r.rung for r in runs] == [1, 1, 0, 0, 0, 0]
    assert runs[0].winner and runs[0].trial == 1 and runs[0].share == 1.0 and runs[2].share == 0.5 and runs[0].test_r2 > 0.8
    assert [r.test_mse is None for r in runs] == [False] + [True] * 5 and runs[0].val_mse <= runs[1].val_mse
    monkeypatch.setattr(pricing, "cross_validate", stops)
    assert [r.trial for r in ask().collect()] == [r.trial for r in runs]


def test_a_search_encodes_its_rows_once(spark, model_table, tmp_path, monkeypatch):
    train, test = features.split(model_table.withColumn("price", F.when(F.col("id") != "hos7", F.col("price"))), "id")
    real, fits = pricing.StringIndexer.fit, []
    monkeypatch.setattr(pricing.StringIndexer, "fit", lambda self, *a: fits.append(1) or real(self, *a))
    params = {"maxIter": 2, "maxDepth": 3}
    found = pricing.search(train, "id", [params, params | {"maxDepth": 4}], k=2, holdout=test).collect()
    assert len(fits) == 1 and {r.trial for r in found} == {0, 1}
    pricing.halving(train, "id", [params] * 4, str(tmp_path), rungs=2, keep=2, k=2, holdout=test)
    assert len(fits) == 2
    # folds and shares follow from the keys, and a share reads its own folders only
    rows, stages = pricing.search_rows(train, "id", 3, shares=(4, 2, 1))
    known = train.filter("price IS NOT NULL")
    assert rows.count() == known.count() < train.count()
    for fold in range(3):
        assert rows.filter(f"fold = {fold}").count() == known.filter(features.bucket_of("id", 21, 3) == fold).count() > 0
    for place, parts in enumerate((4, 2, 1)):
        part = rows.filter(F.col("share") <= place)
        assert part.count() == known.filter(features.bucket_of("id", 5, parts) == 0).count() > 0
        assert "PartitionFilters: [isnotnull(share" in str(part._jdf.queryExecution().executedPlan())
    # a fold's error is that of a model of the other folds, encoded by itself
    alone = pricing.fit_price_model(known.filter(features.bucket_of("id", 21, 3) != 0), skip=("id",), maxIter=3, maxDepth=3, maxBins=1200)
    want = pricing.evaluate(alone, known.filter(features.bucket_of("id", 21, 3) == 0))[0].first()
    got = pricing.cross_validate(train, "id", 3, maxIter=3, maxDepth=3, maxBins=1200).filter("fold = 0").first()
    assert all(abs(got[m] - want[m]) < 1e-9 for m in pricing.METRICS)


def test_shadow_is_a_permutation(spark, model_table):
    out = pricing.shuffled_copies(model_table, ["luas_tanah", "noise"], "id", 3).toPandas()
    assert sorted(out["id"]) == sorted(r.id for r in model_table.select("id").collect())
    for c in ("luas_tanah", "noise"):
        assert sorted(out[c].fillna(-99)) == sorted(out[f"shadow_{c}"].fillna(-99))
    assert abs(out["luas_tanah"].corr(out["shadow_luas_tanah"])) < 0.15
    plan = pricing.permuted(pricing.placed_rows(model_table, "id", 3), 1000, ["noise"], 4)._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan
    for n in (0, 1, 2):
        few = pricing.shuffled_copies(model_table.limit(n), ["noise"], "id", 5).collect()
        assert sorted(str(r.noise) for r in few) == sorted(str(r.shadow_noise) for r in few) and len(few) == n


def test_boruta_accepts_what_matters(spark, model_table):
    got = {r.feature: r for r in pricing.boruta(model_table, "id", trials=8, maxIter=2, maxDepth=4).collect()}
    assert got["luas_tanah"].hits == got["luas_tanah"].trials and got["noise"].hits <= 1
    # an end before the last trial: the trials run beside the last counted one do not count
    seen = []
    ends = pricing.boruta(model_table.select("id", "price", "luas_tanah", "noise"), "id", alpha=0.9, trials=6, maxIter=2, maxDepth=3,
                          parallelism=3, on_trial=lambda n, h: seen.append(n)).collect()
    assert seen == list(range(1, ends[0].trials + 1)) and ends[0].trials < 6 and "tentative" not in {r.status for r in ends}


def test_boruta_indexes_categories_once(spark, model_table, monkeypatch):
    real, fits = pricing.StringIndexer.fit, []
    monkeypatch.setattr(pricing.StringIndexer, "fit", lambda self, *a: fits.append(1) or real(self, *a))
    got = pricing.boruta(model_table, "id", trials=3, maxIter=1, maxDepth=3, parallelism=3)
    assert got.count() == 3 and len(fits) == 1


def test_request_guards_and_rejects(spark, model_table):
    req = spark.createDataFrame(
        [(1, "area1", 100.0, 0.0, 1, 1, 0, 0, 0.0), (2, "nowhere", 100.0, 50.0, 1, 1, 1, 0, 0.0)],
        "rid int, subdistrict string, land_area double, building_area double, num_bedrooms int, num_bathrooms int, num_floors int, year_built int, electricity_rate double")
    f = pricing.request_features(req).first()
    assert f.land_building_ratio == 100.0 and f.building_area_floor_ratio == 0.0
    rows = pricing.request_features(req).select(*pricing.SCORE_FEATURES).withColumn("price", F.explode(F.array(*[F.lit(float(i)) for i in range(20)])))
    model = pricing.fit_price_model(rows, maxIter=1, maxDepth=1)
    scored, rejected = pricing.predict_prices(model, req, model_table)
    assert [r.rid for r in scored.collect()] == [1] and [r.rid for r in rejected.collect()] == [2]


# -- search ------------------------------------------------------------------

def test_bm25_by_hand(spark):
    texts = {"a": "red house, red door", "b": "blue house", "c": "", "d": "garden"}
    docs = spark.createDataFrame(list(texts.items()), "id string, content string")
    got = {r.id: r.score for r in search.bm25(docs, "RED house!", k=None).collect()}
    avg = (4 + 2 + 0 + 1) / 4
    def part(df, tf, dl): return np.log(1 + (4 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avg))
    assert np.isclose(got["a"], part(1, 2, 4) + part(2, 1, 4)) and np.isclose(got["b"], part(2, 1, 2)) and set(got) == {"a", "b"}


def test_ann_recall(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    hits = 0
    for q in e.orderBy("id").limit(5).collect():
        exact = {r.id for r in search.knn(e, q.embedding, 5).collect()}
        hits += len(exact & {r.id for r in search.ann(e, q.embedding, 5).collect()})
    assert hits >= 20


def test_house_images_and_embedding(spark):
    im = spark.createDataFrame([("hos1", "hos1/a.jpg"), ("hos1", "hos1/b.jpg"), ("hos2", "hos2/c.jpg")], "parent_id string, file_path string")
    assert search.house_images(im, "hos1-desc").count() == 2 and search.pick_image(im, "hos1", 4).count() == 1
    with pytest.raises(ValueError):
        search.house_images(im, "x1")
    docs = spark.createDataFrame([("hos1", "doc", "a long description"), ("hos2", "doc", "short")], "id string, content string, description string")
    built = search.embed(search.build_documents(docs), "to_embed")
    assert sorted((r.id, len(r.embedding)) for r in built.collect()) == [("hos1", 64), ("hos1-desc", 64), ("hos2", 64)]
