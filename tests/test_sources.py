import json

import pytest
from pyspark.sql import functions as F

from lotlens.operators import geo
from lotlens.plans import listings
from lotlens.sources import readers, writers
from lotlens.streaming.feed import ingest_stream

LISTING = {
    "id": "hos1", "price": 850.0, "installment": None, "address": "Cibinong, Bogor", "tags": ["KPR", "Cash/Nego"],
    "description": "Rumah bagus dan murah", "specs": {"Luas Tanah": "100 m²", "Kamar Tidur": "3", "Hook": "Ya"},
    "facilities": ["Masjid", "CCTV"], "agent": {}, "images": ["u1", "u2", "u1"], "url": "https://x/hos1",
    "last_modified": "2023-08-07T00:00:00", "scraped_at": "2023-09-01T10:00:00.123456",
}
SQUARE = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
HOLE = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def feature(props, kind, coords):
    return {"type": "Feature", "properties": props, "geometry": {"type": kind, "coordinates": coords}}


@pytest.fixture
def area_file(tmp_path):
    names = {"NAMOBJ": "Cibinong", "WADMKC": "Kec", "WADMKK": "Bogor", "WADMPR": "Jabar"}
    far = [[[10, 10], [12, 10], [12, 12], [10, 12], [10, 10]]]
    doc = {"features": [feature(names, "Polygon", [SQUARE, HOLE]), feature(names | {"NAMOBJ": "Two"}, "MultiPolygon", [[SQUARE], far])]}
    return write(tmp_path / "areas.json", json.dumps(doc))


def test_listings_and_corrupt_lines(spark, tmp_path):
    path = write(tmp_path / "l.jsonl", json.dumps(LISTING) + "\n{broken\n")
    df = readers.read_listings(spark, path)
    assert [r.id for r in df.collect()] == ["hos1"]
    assert readers.read_listings(spark, path, keep_corrupt=True).count() == 2


def test_district_map_list(spark, tmp_path):
    path = write(tmp_path / "d.json", json.dumps([{"source": "a", "target": "b"}, {"source": "a", "target": "c"}]))
    assert readers.read_district_map(spark, path).count() == 2


def test_geojson_and_areas(spark, tmp_path, area_file):
    doc = {"features": [
        feature({"element": "node", "id": 5, "amenity": "cafe", "name": "K"}, "Point", [3, 3]),
        feature({"element": "way", "id": 6, "amenity": "zoo", "name": None}, "Polygon", [SQUARE]),
    ]}
    am = listings.int_amenities(readers.read_geojson(spark, write(tmp_path / "a.json", json.dumps(doc))))
    got = {r.id: (r.category, r.center.x, r.center.y) for r in am.collect()}
    assert got == {5: ("sustenance", 3.0, 3.0), 6: ("other", 2.0, 2.0)}
    areas = listings.stg_areas(*readers.read_areas(spark, area_file))
    inside = listings.amenities_in_areas(am, areas.select("subdistrict", areas.geom.alias("shape")).withColumnRenamed("shape", "geom"))
    assert sorted((r.id, r.subdistrict) for r in inside.collect()) == [(5, "Cibinong"), (5, "Two"), (6, "Two")]


def test_collection_is_split_at_its_features(spark, tmp_path):
    tricky = 'a "type":"Feature", {"type":"Feature","x":1} \\\\ ü\\n]}'
    many = [feature({"element": "node", "id": i, "amenity": tricky if i % 7 == 0 else "cafe", "name": None if i % 5 else "é" * (i % 40)}, "Point", [i, -i])
            for i in range(3000)]
    many[5] = feature({"element": "way", "id": 5, "amenity": "zoo", "name": "n"}, "MultiPolygon", [[SQUARE], [SQUARE]])
    typed = [{"type": "Feature"} | f for f in many]
    doc = {"type": "FeatureCollection", "name": "x", "features": typed}
    want = readers.read_geojson(spark, write(tmp_path / "lines.json", "\n".join(map(json.dumps, many))), lines=True)
    rows = lambda df: sorted(map(str, df.collect()))
    forms = {"tight": json.dumps(doc, separators=(",", ":")), "wide": json.dumps(doc, indent=2), "plain": json.dumps(doc)}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        for name, text in forms.items():
            got = readers.read_geojson(spark, write(tmp_path / f"{name}.json", text))
            assert got.rdd.getNumPartitions() > 4 and rows(got) == rows(want)
        # a document whose features open with their properties is read whole, beside split ones
        (tmp_path / "mixed").mkdir()
        write(tmp_path / "mixed" / "a.json", json.dumps({"features": [{"properties": f["properties"], "type": "Feature", "geometry": f["geometry"]} for f in many[:9]]}))
        write(tmp_path / "mixed" / "b.json", json.dumps({"features": typed[9:]}))
        write(tmp_path / "mixed" / "c.json", json.dumps({"features": []}))
        assert rows(readers.read_geojson(spark, str(tmp_path / "mixed"))) == rows(want)
        other = json.dumps(typed[1]).replace('"type": "Feature"', '"type" : "Feature"')
        odd = readers.read_geojson(spark, write(tmp_path / "odd.json", f'{{"features": [{json.dumps(typed[0])}, {other}]}}'))
        with pytest.raises(Exception, match="open differently"):
            odd.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_centroids(spark, area_file):
    got = {r.subdistrict: (round(r.center.x, 6), round(r.center.y, 6)) for r in listings.stg_areas(*readers.read_areas(spark, area_file)).collect()}
    # square 16 at (2,2) less hole 1 at (1.5,1.5); square 16 at (2,2) with square 4 at (11,11)
    assert got == {"Cibinong": (round(30.5 / 15, 6), round(30.5 / 15, 6)), "Two": (3.8, 3.8)}


def test_point_on_border_is_outside(spark, area_file):
    area = listings.stg_areas(*readers.read_areas(spark, area_file)).filter("subdistrict = 'Cibinong'")
    pts = [(0.0, 2.0), (4.0, 4.0), (0.5, 0.5), (1.5, 1.5), (1.0, 1.5), (3.0, 1.0), (9.0, 9.0)]
    p = spark.createDataFrame(pts, "x double, y double").select(F.struct("x", "y").alias("p"))
    hit = geo.spatial_join(p, area.select("subdistrict", "geom"), "p", "geom").filter("subdistrict IS NOT NULL")
    assert sorted((r.p.x, r.p.y) for r in hit.collect()) == [(0.5, 0.5), (3.0, 1.0)]


def test_geojson_round_trip(spark, tmp_path, area_file):
    areas = readers.read_areas(spark, area_file)[0]
    out = str(tmp_path / "out")
    writers.export_geojson(areas, out)
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert {tuple(f["bbox"]) for f in lines} == {(0, 0, 4, 4), (0, 0, 12, 12)}
    assert all(f["type"] == "Feature" and f["properties"]["WADMPR"] == "Jabar" for f in lines)
    again = readers.read_areas(spark, out, lines=True)[0]
    assert sorted(map(str, again.collect())) == sorted(map(str, areas.collect()))


SMALL = "id int, s string"


def inserted(spark, target, schema=SMALL):
    df = writers.read_inserted(spark, target, spark.createDataFrame([], schema).schema)
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_insert_new_is_idempotent(spark, tmp_path):
    target = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], SMALL)
    for batch in (first, first, spark.createDataFrame([(2, "z"), (3, "d"), (None, "m")], SMALL), first.limit(0)):
        writers.insert_new(batch, target, ["id"])
    assert inserted(spark, target) == [(1, "a"), (2, "c"), (3, "d"), (None, "n")]
    assert writers.committed(spark, target) == {"direct": 3}
    assert inserted(spark, str(tmp_path / "none")) == []


def test_replay_after_half_an_append(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "t")
    rows = [(i, f"r{i}") for i in range(50)]
    writers.insert_new(spark.createDataFrame(rows[:20], SMALL), target, ["id"], writer="feed", batch=0)
    batch = spark.createDataFrame([(i, "again" if i < 20 else s) for i, s in rows[10:]], SMALL)

    def lost(*_):
        raise OSError("the driver is lost before the ledger is written")

    real = writers._commit
    monkeypatch.setattr(writers, "_commit", lost)
    with pytest.raises(OSError):
        writers.insert_new(batch, target, ["id"], writer="feed", batch=1)
    assert inserted(spark, target) == sorted(rows[:20], key=str)  # the rows are there, but not committed
    half = [p for p in (tmp_path / "t").rglob("*.parquet") if "_batch=1" in str(p)]
    assert half
    half[0].unlink()  # and some of them are not even there
    monkeypatch.setattr(writers, "_commit", real)
    for _ in range(2):
        writers.insert_new(batch, target, ["id"], writer="feed", batch=1)
        assert inserted(spark, target) == sorted(rows, key=str)
    writers.insert_new(spark.createDataFrame([(99, "old number")], SMALL), target, ["id"], writer="feed", batch=0)
    writers.insert_new(spark.createDataFrame([(7, "x"), (77, "y")], SMALL), target, ["id"], writer="other", batch=0)
    assert inserted(spark, target) == sorted([*rows, (77, "y")], key=str)
    assert len(list((tmp_path / "t" / "_ledger").rglob("[0-9]*"))) == 2


def test_insert_reads_the_slots_of_its_keys_only(spark, tmp_path):
    target = str(tmp_path / "t")
    writers.insert_new(spark.createDataFrame([(i, "a") for i in range(500)], SMALL), target, ["id"])
    some = writers.read_inserted(spark, target, spark.createDataFrame([], SMALL).schema, [3, 5])
    assert {p.split("_slot=")[1].split("/")[0] for p in (r[0] for r in some.select(F.input_file_name()).distinct().collect())} == {"3", "5"}


def test_publish_skips_downstream():
    names = ["marts_dim_a", "marts_downstream_b", "stg_c", "marts_fact"]
    assert writers.published_names(names) == ["marts_dim_a", "marts_fact"]


def test_images(spark, tmp_path):
    for rel in ("hos1/a b.jpg", "deep/hos2/c.jpg", "hos1/skip.png"):
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(b"x")
    got = sorted((r.parent_id, r.file_path) for r in readers.list_images(spark, str(tmp_path)).collect())
    assert got == [("hos1", "hos1/a b.jpg"), ("hos2", "hos2/c.jpg")]


def test_feed(spark, tmp_path):
    feed, target, ck = (str(tmp_path / n) for n in ("feed", "target", "ck"))
    (tmp_path / "feed").mkdir()
    again = LISTING | {"price": 1.0}
    write(tmp_path / "feed" / "1.json", "\n".join(map(json.dumps, [LISTING, LISTING, LISTING | {"id": "hos2"}])))
    ingest_stream(spark, feed, target, ck)
    write(tmp_path / "feed" / "2.json", "\n".join(map(json.dumps, [again, LISTING | {"id": "hos3"}, LISTING | {"id": "old", "scraped_at": "2001-01-01T00:00:00"}])))
    ingest_stream(spark, feed, target, ck)
    landed = writers.read_inserted(spark, target, spark.createDataFrame([], readers.LISTING_SCHEMA).schema)
    assert sorted((r.id, r.price) for r in landed.collect()) == [("hos1", 850.0), ("hos2", 850.0), ("hos3", 850.0), ("old", 850.0)]


def test_star_schema(spark, tmp_path, area_file):
    path = write(tmp_path / "l.jsonl", "\n".join(json.dumps(x) for x in [
        LISTING, LISTING | {"id": "hos2", "price": None}, LISTING | {"id": "hos3", "address": "Cbn, Bogor", "tags": [], "facilities": None}]))
    raw = readers.read_listings(spark, path)
    districts = spark.createDataFrame([("Cbn", "Cibinong")], "source string, target string")
    areas = listings.stg_areas(*readers.read_areas(spark, area_file))
    doc = {"features": [feature({"element": "node", "id": 5, "amenity": "cafe", "name": "K"}, "Point", [3, 3])]}
    amen = readers.read_geojson(spark, write(tmp_path / "am.json", json.dumps(doc)))
    marts = listings.star_schema(raw, districts, areas, amen)
    wide = {r.id: r for r in marts["marts_downstream_houses"].collect()}
    assert sorted(wide) == ["hos1", "hos3"]
    assert wide["hos1"].price == 850e6 and wide["hos1"].luas_tanah == 100.0 and wide["hos1"].tags == ["kpr", "cash", "nego"]
    assert wide["hos1"].amenities.sustenance == 1 and wide["hos3"].subdistrict == "Cibinong"
    assert wide["hos3"].tags is None and wide["hos3"].facilities is None and wide["hos1"].ruang_tamu == 1
    assert marts["marts_fact_houses"].count() == 4  # two distinct images each
    tags = {r.tag_sk for r in marts["marts_dim_tags"].collect()}
    assert {r.tag_sk for r in marts["marts_bridge_house_tags"].collect()} <= tags
    assert marts["marts_dim_amenities"].first().category_name == "Sustenance"
