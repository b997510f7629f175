"""Payload flattening, page extractors and collector CSVs on hand-made rows."""

import json

from pyspark.sql import functions as F

from staylink.functions.parsing import extract_host, extract_licence, parse_airbnb_title, parse_vrbo_heading
from staylink.sources.csv_io import read_listings_csv
from staylink.sources.payloads import flatten_booking, flatten_vrbo


def test_vrbo_heading(spark):
    df = spark.createDataFrame([("Villa · 8 huéspedes · 4 habitaciones · 2 baños",), ("",), (None,),
                                ("Casa · 1 habitación · 3 huéspedes · 5 huéspedes",)], "h string")
    got = [tuple(r[0]) for r in df.select(parse_vrbo_heading("h")).collect()]
    assert got == [("Villa", 8, 4), (None, None, None), (None, None, None), ("Casa", 5, 1)]
    t = spark.createDataFrame([("Villa · 4 bedrooms · 2 baths",)], "t string")
    assert tuple(t.select(parse_airbnb_title("t")).first()[0]) == (4, 2)


def test_flatten_booking_optional_display_name(spark):
    payload = {"data": {"searchQueries": {"search": {"results": [
        {"basicPropertyData": {"pageName": "a", "location": {"latitude": 39.5, "longitude": 2.6}},
         "displayName": {"text": "Casa A"}},
        {"basicPropertyData": {"pageName": "b", "location": {"latitude": 39.6, "longitude": 2.7}}}]}}}}
    df = spark.createDataFrame([(1, json.dumps(payload))], "payload_id long, payload string")
    rows = [(r["name"], r["DisplayName"]) for r in flatten_booking(df).orderBy("pos").collect()]
    assert rows == [("a", "Casa A"), ("b", None)]


def test_flatten_vrbo_drops_unmarked_and_last_marker_wins(spark):
    payload = {"data": {"propertySearch": {
        "dynamicMap": {"map": {"markers": [{"id": "1", "markerPosition": {"latitude": 1.0, "longitude": 1.0}},
                                           {"id": "1", "markerPosition": {"latitude": 2.0, "longitude": 2.0}}]}},
        "propertySearchListings": [
            {"id": "1", "headingSection": {"heading": "A", "messages": [{"text": "Villa · 2 huéspedes"}]}},
            {"id": "9", "headingSection": {"heading": "B", "messages": []}}]}}}
    df = spark.createDataFrame([(1, json.dumps(payload))], "payload_id long, payload string")
    rows = flatten_vrbo(df).collect()
    assert [(r["id"], r["lat"], r["tipo"], r["capacidad"]) for r in rows] == [("1", 2.0, "Villa", 2)]


def test_extractors(spark):
    df = spark.createDataFrame([
        ("vrbo", "Propietario/a: Ana\nNúmero de registro de la propiedad ETV/123\n"),
        ("vrbo", "Licencia turística: VT-9\n"),
        ("holidu", "Gestionado por Holidu\nNúmero de licencia: X1"),
        ("holidu", "Nuestro socio verificado Casas SL gestionará tu reserva"),
        ("booking", 'x "HotelierInfo","name":"Hotelero" y'),
        ("booking", "Grupo Sol\nMarca/cadena de hotel\n"),
        ("airbnb", '{"a":{"title":"Anfitrión: Eva"}}'),
    ], "p string, t string")
    got = [(r[0], r[1]) for r in df.select(extract_licence("p", "t"), extract_host("p", "t")).collect()]
    assert got == [("ETV/123", "Ana"), ("VT-9", None), ("X1", "Holidu"), (None, "Casas SL"),
                   (None, "Hotelero"), (None, "Grupo Sol"), (None, "Eva")]


def test_read_listings_csv(spark, tmp_path):
    p = tmp_path / "booking.csv"
    p.write_text('name,lat,lng,DisplayName,habitaciones,licencia,capacidad,niños,tipo de alojamiento,anfitrion,url,'
                 'fecha,isla\nbk1,39.5,2.6,"Casa, ""A""",2,ETV/1,4,0,Villa,Ana,u,2025-06-24,mallorca\n',
                 encoding="utf-8")
    r = read_listings_csv(spark, str(p), "booking").first()
    assert (r["listing_id"], r["nombre"], r["tipo"], r["plataforma"], str(r["fecha"])) == \
        ("bk1", 'Casa, "A"', "Villa", "booking", "2025-06-24")


def test_rejected_rows_and_split_files(spark, tmp_path):
    p = tmp_path / "holidu.csv"
    head = "id,lat,lng,nombre,habitaciones,capacidad,tipo,licencia,anfitrion,url,fecha,isla\n"
    good = "".join(f"h{i},39.5,2.6,Casa,2,4,Villa,ETV/{i},Ana,u,2025-06-24,ibiza\n" for i in range(300))
    bad = "hx,north,2.6,Casa,2,four,Villa,ETV/9,Ana,u,2025-06-24,ibiza\n"
    p.write_text(head + good + bad, encoding="utf-8")
    got = read_listings_csv(spark, str(p), "holidu", multiline=False, rejected="raw").cache()
    assert got.count() == 301 and got.where("raw is null").count() == 300
    r = got.where("raw is not null").first()
    assert r.raw == bad.strip() and r.lat is None and r.capacidad is None and (r.listing_id, r.lng, r.licencia) == ("hx", 2.6, "ETV/9")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert read_listings_csv(spark, str(p), "holidu", multiline=False).rdd.getNumPartitions() > 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_snapshots_coexist_and_csv_keeps_quotes(spark, tmp_path):
    from staylink.sources.csv_io import write_listings
    schema = "plataforma string, fecha string, nombre string"
    for name in ("parquet", "csv"):
        out = f"{tmp_path}/{name}"
        write_listings(spark.createDataFrame([("airbnb", "2025-06-01", 'a "b"\nc, d')], schema), out, name)
        write_listings(spark.createDataFrame([("booking", "2025-06-02", "e")], schema), out, name)
        back = spark.read.parquet(out) if name == "parquet" else \
            spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(out)
        assert {(r.plataforma, str(r.fecha), r.nombre) for r in back.collect()} == \
            {("airbnb", "2025-06-01", 'a "b"\nc, d'), ("booking", "2025-06-02", "e")}


def test_booking_page_reads_source_and_text(spark):
    from staylink.functions import parsing
    from staylink.sources.pages import extract_page_attributes
    df = spark.createDataFrame([("1", "booking", "<p>nothing</p>", "x", 0)],
                               "listing_id string, plataforma string, page_html string, page_text string, capture int")
    assert extract_page_attributes(df).first().licencia is None and parsing.HOST_MAX_CHARS
