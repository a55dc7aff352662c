"""Readers and sinks on small files."""

import json

import pytest

from siteweave.config import DEFAULT
from siteweave.functions.geo import WORLD, Box
from siteweave.operators import select
from siteweave.sources import readers, sinks
from tests.records import frame, record

ALPS = Box(45, 5, 56, 17.5)


def feature(id_, lon, lat, **p):
    return {"id": id_, "geometry": {"coordinates": [lon, lat]}, "properties": {"name": f"Hill {id_}", "countryCode": "au", "takeoff_altitude": "120", "N": "1", "S": "2"} | p}


def test_features(spark, tmp_path):
    zone = {"landing_lat": "-33.5", "landing_lng": "151.0", "landing_name": "null", "landing_altitude": "-5", "landing_description": " big "}
    doc = {"features": [
        feature("7", "151.0", "-33.6", landing=zone, pge_link="http://x/7", winch="1"), feature("8", 151.1, -33.7, landing=zone | {"landing_lat": "-33.500001"}, takeoff_altitude="-3", pge_site_id="88"),
        feature("9", "x", "1"), {"id": "10", "geometry": {"coordinates": [1]}, "properties": {}}, feature(None, 1, 1), feature("11", 11.0, 46.0, name="Landeplatz 1"),
    ]}
    path = tmp_path / "f.json"
    path.write_text(json.dumps(doc))
    rows = {r.key: r for r in readers.read_feature_points(spark, str(path), WORLD).collect()}
    assert set(rows) == {"pge:7", "pge:88", "pge:11"}
    assert (rows["pge:7"].tow, rows["pge:7"].altitude, rows["pge:7"].country, rows["pge:7"].url, rows["pge:7"].wind) == (True, 120.0, "AU", "https://x/7", {"N": 1, "S": 2})
    assert rows["pge:88"].altitude is None and rows["pge:11"].role == "landing"
    (z,) = readers.read_feature_landings(spark, str(path), WORLD).collect()
    assert (z.key, z["name"], z.role, z.group_ids, z.altitude, z.notes, z.wind) == ("pge:7-lz", "Hill 7 Landing", "landing", ["7", "88"], None, "big", {})
    assert readers.read_feature_points(spark, str(path), ALPS).count() == 1


def test_nested_export(spark, tmp_path):
    launch = lambda i, **k: {"id": i, "lat": -33.0, "lon": 151.0} | k
    doc = {
        "sites": [
            {"id": 1, "name": "Bluff", "conditions": "SW-NW", "shortLocation": "available to SHC members", "height": "300ft/90m", "closed": "site", "landing": " ", "mapShapeIds": [5, 6], "launches": [launch(1, name="Main", conditions="E"), launch(2, closed="shut"), launch(3, lat=None)]},
            {"id": 2, "name": None, "landing": "Grass", "mapShapeIds": [5], "launches": []},
        ],
        "mapShapes": [
            {"id": 5, "name": None, "category": {"name": "Landing"}, "coordinatesList": ["151,-33 152,-34"]},
            {"id": 6, "name": "Road", "category": {"name": "Access"}, "coordinatesList": ["151,-33"]},
            {"id": 7, "name": "Alone", "category": {"name": "Landing"}, "coordinatesList": ["151,-33"]},
        ],
    }
    path = tmp_path / "n.json"
    path.write_text(json.dumps(doc))
    rows = {r.key: r for r in readers.read_nested_launches(spark, str(path), WORLD).collect()}
    a, b = rows["ansg:1-1"], rows["ansg:1-2"]
    assert len(rows) == 2 and (a["name"], a.wind, a.altitude, a.closed, a.approximate_location) == ("Bluff - Main", {"E": 1}, 90.0, "site", True)
    assert (b["name"], b.wind, b.closed) == ("Bluff", {"SW": 1, "W": 1, "NW": 1}, "shut")
    (z,) = readers.read_polygon_landings(spark, str(path), WORLD).collect()
    assert (z.key, z["name"], z.lat, z.lon, z.group_ids, z.notes) == ("ansg:lz-5", "Landing", -33.5, 151.5, ["1", "2"], "Grass")


def test_kml(spark, tmp_path):
    def mark(name, style, text, at):
        return f"<Placemark><name>{name}</name><description><![CDATA[{text}]]></description><styleUrl>#{style}</styleUrl><Point><coordinates>{at}</coordinates></Point></Placemark>"

    marks = [
        mark("Berg Start 1", "dhv_startplatz", "Startrichtung SSO-SSW<br/>Höhe NN 350m<br/>x?item=57", "9.6,49.3"), mark("!!!", "dhv_startplatz", "item=57", "9.6,49.3"),
        mark("Bräu O", "dhv_startplatz", "Startrichtung O, W<br/>Höhe NN -3 m, item=14", "13.7,47.6"), mark("Feld", "dhv_schlepp", "item=42", "9.8,49.3"),
        mark("Platz", "dhv_landeplatz", "item=57", "9.6,49.3"), mark("Weit", "dhv_startplatz", "item=8", "151.3,-33.7"), mark("Ohne", "dhv_startplatz", "nichts", "9.6,49.3"), mark("Anders", "x", "item=1", "9.6,49.3"),
    ]
    path = tmp_path / "a.kml"
    path.write_text('<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>' + "".join(marks) + "</Document></kml>")
    rows = {r.id: r for r in readers.read_kml_areas(spark, str(path), "DE", ALPS).collect()}
    assert set(rows) == {"57-berg-start-1", "14-braeu-o", "42-feld", "57-platz"}
    assert (rows["57-berg-start-1"].wind, rows["57-berg-start-1"].altitude) == ({"S": 1}, 350.0)
    assert (rows["14-braeu-o"].wind, rows["14-braeu-o"].altitude) == ({"E": 1, "W": 1}, -3.0)
    assert rows["42-feld"].tow and rows["57-platz"].role == "landing" and rows["57-platz"].group_ids == ["57"]


def test_union_and_unique(spark):
    guides = {"pge": (WORLD, lambda box: frame(spark, [record()])), "dhv": (ALPS, lambda box: frame(spark, [record("dhv:1")]))}
    assert readers.union_records(guides, Box(-44, 112, -10, 154)).count() == 1
    with pytest.raises(ValueError):
        readers.require_unique(frame(spark, [record(), record()]))
    with pytest.raises(ValueError):
        DEFAULT.check_guides(["pge", "new"])


@pytest.mark.parametrize("rows", [[("a", "a", "never")], [("a", "b", "maybe")], [("", "b", "never")], [("a", "b", "never"), ("b", "a", "always")], [(None, "b", "never")]])
def test_bad_overrides(spark, rows):
    with pytest.raises(ValueError):
        readers.checked_overrides(spark.createDataFrame(rows, "a string, b string, verdict string"))


def test_flat_csv(spark, tmp_path):
    df = frame(spark, [record(name='He said "hi", ok\r\nthere', altitude=2.5, closed="a;b"), record("ansg:z", 9000, country=None, role="landing", name="Z")])
    clusters = spark.createDataFrame([("pge:1", "SITE-000002"), ("ansg:z", "SITE-000010")], "key string, cluster_id string")
    sites = select.select_canonical(select.members(df, clusters)).withColumnRenamed("cluster_id", "id")
    sinks.write_flat_csv(sites.coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    lines = part.read_bytes().decode()
    assert lines.startswith(",".join(sinks.FLAT_COLUMNS) + '\n2,pge:1,"He said ""hi"", ok\nthere",151.300000,-33.700000,2,au,1,2,')
    back = {r.ref: r for r in readers.read_published(spark, str(tmp_path / "out"), DEFAULT.precedence).collect()}
    assert back["ansg:z"].role == "landing" and back["pge:1"].providers == ["pge"]
    sinks.write_country_shards(sites, str(tmp_path / "shards"))
    assert {p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()} == {"country=au", "country=xx"}
    assert {r.status for r in sinks.shard_changes(sites, sites).collect()} == {"unchanged"}


def test_old_published_file(spark, tmp_path):
    (tmp_path / "old.csv").write_text("id,name,longitude,latitude,source\n1,a,1.0,2.0,dhv:5;pge:3\n2,b,x,2.0,pge:4\n3,c,1.0,2.0,;pge:\n")
    (r,) = readers.read_published(spark, str(tmp_path / "old.csv"), DEFAULT.precedence).collect()
    assert (r.ref, r.role, r.providers) == ("pge:3", "launch", ["dhv", "pge"])
