"""Column functions against values worked out by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from siteweave.config import DEFAULT, DIRECTIONS
from siteweave.functions import geo, text, wind


def one(spark, column, value=None, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column.alias("y")).first().y


@pytest.mark.parametrize(
    "said, points",
    [
        ("E", "E"), ("E-SE", "E,SE"), ("All", ",".join(DIRECTIONS)), ("Any", ",".join(DIRECTIONS)), ("Various", ",".join(DIRECTIONS)),
        ("WSW-WNW", "W"), ("North East", "NE"), ("NW-SW", "SW,W,NW"), ("South to South East", "SE,S"), ("SE-NE", "NE,E,SE"),
        ("NW- WSW (best WNW)", "W,NW"), ("SW-S-SE", "SE,S,SW"), ("W-SSW, Thermic", "SW,W"), ("SSW to SSE", "S"), ("SSE", "SE,S"),
        ("SE, NE, W", "NE,SE,W"), ("SE?", "SE"), ("N-S", "N,NE,E,SE,S"), (None, ""), ("", ""), ("Thermic", ""), ("soarable over 10 knots", ""),
    ],
)
def test_parse_conditions(spark, said, points):
    assert ",".join(one(spark, wind.parse_conditions(F.col("x")), said)) == points


def test_graded_wind(spark):
    grades = dict(zip(DIRECTIONS, map(F.lit, ("0", "1", "2", " 1 ", "3", "", "x", "0"))))
    assert one(spark, wind.graded_wind(grades)) == {"NE": 1, "E": 2, "SE": 1}


@pytest.mark.parametrize(
    "said, height",
    [("280'/85m asl, 250' agl", 85.0), ("2,450ft / 750m ASL", 750.0), ("55m / 170ft", 55.0), ("170ft", 51.8), ("1,000'", 304.8), ("12.5", 12.5), ("high", None), (None, None), ("", None)],
)
def test_parse_height(spark, said, height):
    assert one(spark, text.parse_height(F.col("x")), said) == height


@pytest.mark.parametrize("said, out", [("12", 12.0), ("12.5", 12.5), (".5", 0.5), ("5.", 5.0), ("-3", None), ("1.2.3", None), ("x", None), ("", None), (None, None)])
def test_unsigned_decimal(spark, said, out):
    assert one(spark, text.unsigned_decimal(F.col("x")), said) == out


@pytest.mark.parametrize("said, out", [(" a \n", "a"), (" b ", "b"), ("  ", None), ("", None), (None, None)])
def test_clean_text(spark, said, out):
    assert one(spark, text.clean_text(F.col("x")), said) == out


def test_ring_centroid(spark):
    at = one(spark, text.ring_centroid(F.array(F.col("x"))), "1,2 3,4 bad,x 5,6")
    assert (at.lat, at.lon) == (4.0, 3.0)
    assert one(spark, text.ring_centroid(F.array(F.col("x"))), "nothing") is None


@pytest.mark.parametrize("said, out", [("NNO-SSO", "NNE-SSE"), ("O, W", "E, W"), ("NO bis Ost", "NE bis Ost"), ("SSW", "SSW")])
def test_german_compass(spark, said, out):
    assert one(spark, text.german_compass(F.col("x")), said) == out


@pytest.mark.parametrize("name, out", [("Loser Startplatz 3 Bräuningalm", "loser-startplatz-3-braeuningalm"), ("!!! ---", ""), ("Été à Æsch", "ete-a-sch"), ("Größe", "groesse"), (None, None)])
def test_slugify(spark, name, out):
    assert one(spark, text.slugify(F.col("x")), name) == out


@pytest.mark.parametrize(
    "a, b, out",
    [("Muckenkogel Landeplatz 1", "Muckenkogel Landing", 74), ("Virgen Landeplatz", "Golplan Landing", 38), ("Bald Hill", "Bald Hill - Launch 3", 100), ("", "x", None), (None, "x", None), (" ", "x", 0)],
)
def test_similarity(a, b, out):
    found = text.similarity(a, b)
    assert found is None if out is None else round(found) == out


def test_common_length_against_the_table():
    def table(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
        return row[-1]

    import random

    r = random.Random(3)
    for _ in range(300):
        a, b = ("".join(r.choice("abc ") for _ in range(r.randrange(12))) for _ in "ab")
        assert text.common_length(a, b) == table(a, b)


def test_tokens_and_ref(spark):
    coded = F.map_from_arrays(F.array(F.lit("zzz"), F.lit("aaa")), F.array(F.lit("9"), F.lit("1")))
    assert one(spark, text.encode_tokens(coded)) == "aaa:1;zzz:9"
    assert one(spark, text.ref_for(coded, DEFAULT.precedence)) == "aaa:1"
    decoded = text.decode_tokens(F.col("x"))
    assert one(spark, decoded, "pge:1;bad;:2;dhv:;ansg:a:b;pge:3") == {"ansg": "a:b", "pge": "3"}
    assert one(spark, text.ref_for(decoded, DEFAULT.precedence), "ansg:136-40;pge:4632") == "pge:4632"
    assert one(spark, decoded, None) == {}


def test_labels(spark):
    assert one(spark, text.member_label(F.lit("pge"), F.lit("A|B"), F.lit("u"))) == "**pge** [A\\|B](u)"
    assert one(spark, text.member_label(F.lit("pge"), F.lit("A"), F.lit(None))) == "**pge** A"
    assert one(spark, text.override_entry(F.lit("a:1"), F.lit("b:2"), "never")) == '{"a": "a:1", "b": "b:2", "verdict": "never", "reason": ""}'
    assert one(spark, text.normalise_newlines(F.col("x")), "a\r\nb\rc\n") == "a\nb\nc\n"
    assert one(spark, text.page_url(F.col("x"), F.lit("d")), "http://a/b") == "https://a/b"
    assert one(spark, text.page_url(F.col("x"), F.lit("d")), " ") == "d"


def test_distance_and_boxes(spark):
    def reference(a, b, c, d):
        h = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
        return 2 * 6371000 * math.asin(math.sqrt(h))

    points = [(0.0, 0.0, 0.0, 1.0), (47.0, 11.0, 47.001, 11.001), (-33.7, 179.999, -33.7, -179.999), (90.0, 0.0, -90.0, 0.0)]
    df = spark.createDataFrame(points, "a double, b double, c double, d double").select(geo.haversine_m(*map(F.col, "abcd")).alias("m"))
    assert [r.m for r in df.collect()] == pytest.approx([reference(*p) for p in points])
    box = geo.Box(0, 0, 10, 10)
    assert geo.bbox_intersect(box, geo.Box(10, 0, 20, 10)) is None
    assert geo.bbox_intersect(box, geo.Box(5, 5, 20, 20)) == geo.Box(5, 5, 10, 10)
    assert one(spark, geo.in_bbox(F.lit(10.0), F.lit(0.0), box)) is True


def test_similarity_as_a_column(spark):
    """The column expression against the plain function: words, odd spaces, marks, names beyond one and beyond two words of bits."""
    r = random.Random(12)
    pool = ["hill", "ridge", "Öd", "launch", "a|b", "x" * 70, "é" * 40, "north", "West", "10", "kite gap", "𝒳y"]
    name = lambda: r.choice([" ", "\t", "  "]).join(r.choice(pool) + r.choice(["", "s", str(r.randrange(30))]) for _ in range(r.randrange(12)))
    rows = [(i, name(), name()) for i in range(250)] + [(300, None, "a"), (301, "a", None), (302, "", "a"), (303, "  ", "a"), (304, "a b", "b a c"), (305, "abcdefgh" * 20, "bcdefgha" * 20), (306, "x" * 62, "x" * 61 + "y"), (307, "y" + "x" * 124, "x" * 125)]
    df = spark.createDataFrame(rows, "i int, a string, b string").withColumn("s", text.name_similarity("a", "b"))
    assert "Python" not in df._jdf.queryExecution().toString()
    for x in df.collect():
        want = text.similarity(x.a, x.b)
        assert x.s == (want if want is None else pytest.approx(want, abs=1e-9)), x


def test_wind_prose_is_cleaned_once(spark):
    """Each step stands in the plan once: it isn't computed again for each of the eight directions."""
    plan = spark.range(1).select(wind.parse_conditions(F.col("id").cast("string")).alias("w"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("regexp_extract_all(") == 1 and plan.count("regexp_replace(") == 2 + len(wind.SPELLED)
