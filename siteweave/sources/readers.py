"""Landed files of the guides, read with fixed schemas into records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.config import DEFAULT, DIRECTIONS, RECORD_COLUMNS, RECORD_SCHEMA, Config
from siteweave.functions.geo import Box, bbox_intersect, in_bbox
from siteweave.functions.text import (
    approximate_flag,
    clean_text,
    decode_tokens,
    german_compass,
    infer_role,
    page_url,
    parse_height,
    ref_for,
    ring_centroid,
    slugify,
    unsigned_decimal,
)
from siteweave.functions.wind import as_wind, graded_wind, parse_conditions
from siteweave.sources.documents import array_items

_FEATURE = (
    "id string, geometry struct<coordinates: array<string>>, properties struct<pge_site_id: string, name: string, "
    + ", ".join(f"{d}: string" for d in DIRECTIONS)
    + ", takeoff_altitude: string, countryCode: string, pge_link: string, winch: string, landing: struct<landing_lat: string, landing_lng: string, "
    "landing_altitude: string, landing_name: string, landing_description: string>>"
)
_SITE = (
    "id string, name string, conditions string, shortLocation string, height string, closed string, landing string, "
    "mapShapeIds array<bigint>, launches array<struct<id: string, name: string, lat: double, lon: double, conditions: string, closed: string>>"
)
_MAP_SHAPE = "id bigint, name string, category struct<name: string>, coordinatesList array<string>"
_LINE, _AREA = "struct<coordinates: string>", "struct<outerBoundaryIs: struct<LinearRing: struct<coordinates: string>>>"
_SHAPES = {"Point": _LINE, "LineString": _LINE, "LinearRing": _LINE, "Polygon": _AREA}
_PLACEMARK = "name string, description string, styleUrl string, " + ", ".join(f"{n} {t}" for n, t in _SHAPES.items())
_PLACEMARK += ", MultiGeometry struct<" + ", ".join(f"{n}: {t}" for n, t in _SHAPES.items()) + ">"

# Placemark styles and what they mean (role, tow).
KML_STYLES = {"dhv_startplatz": ("launch", False), "dhv_schlepp": ("launch", True), "dhv_landeplatz": ("landing", False)}


def as_records(df: DataFrame, provider: str) -> DataFrame:
    """The record columns in order; those a guide doesn't have are null, false or empty."""
    types = {c.split(" ", 1)[0]: c.split(" ", 1)[1] for c in RECORD_SCHEMA.split(", ")}
    df = df.withColumn("provider", F.lit(provider)).withColumn("key", F.concat(F.lit(provider + ":"), "id"))
    fill = {"tow": F.lit(False), "approximate_location": F.lit(False), "wind": F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))}
    return df.select(*[(F.col(c) if c in df.columns else fill.get(c, F.lit(None))).cast(types[c]).alias(c) for c in RECORD_COLUMNS])


def _items(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    """pos, item: the objects of an array of all documents. pos orders them, by file and then by place."""
    found = array_items(spark, path, name)
    return found.select(F.struct("file", "range", "nth").alias("pos"), F.from_json("body", schema).alias("item")).where("item is not null")


def _features(spark: SparkSession, path: str) -> DataFrame:
    rows = _items(spark, path, "features", _FEATURE).withColumnRenamed("item", "f")
    p = F.col("f.properties")
    return rows.select("pos", "f", p.alias("p"), F.coalesce(clean_text(p["pge_site_id"]), clean_text(F.col("f.id"))).alias("site"), F.coalesce(clean_text(p["name"]), F.lit("Unknown site")).alias("title"))


def _own_page(template: str, link: Column, site: Column) -> Column:
    return page_url(link, F.replace(F.lit(template), F.lit("{id}"), site))


def read_feature_points(spark: SparkSession, path: str, box: Box, provider: str = "pge", template: str = "https://example.org/?site={id}") -> DataFrame:
    """GeoJSON features as launches (landings by name)."""
    at = F.col("f.geometry.coordinates")
    rows = _features(spark, path).withColumn("lon", F.get(at, F.lit(0)).try_cast("double")).withColumn("lat", F.get(at, F.lit(1)).try_cast("double"))
    p = F.col("p")
    good = rows.where(F.col("site").isNotNull() & in_bbox(F.col("lat"), F.col("lon"), box))
    out = good.select(
        F.col("site").alias("id"),
        F.col("title").alias("name"),
        infer_role(F.col("title")).alias("role"),
        "lat",
        "lon",
        graded_wind({d: p[d] for d in DIRECTIONS}).alias("wind"),
        unsigned_decimal(clean_text(p["takeoff_altitude"])).alias("altitude"),
        F.upper(clean_text(p["countryCode"])).alias("country"),
        _own_page(template, p["pge_link"], F.col("site")).alias("url"),
        (F.trim(F.coalesce(p["winch"], F.lit("0"))) == "1").alias("tow"),
        F.array("site").alias("group_ids"),
    )
    return as_records(out, provider)


def read_feature_landings(spark: SparkSession, path: str, box: Box, provider: str = "pge", template: str = "https://example.org/?site={id}") -> DataFrame:
    """Landings nested in takeoffs, one for each place (5 decimals); the first takeoff names it, all are its groups. First
    is by the path of the file, then by place in it, so several files give one result however they are read."""
    z = F.col("p.landing")
    rows = _features(spark, path).withColumn("lat", clean_text(z["landing_lat"]).try_cast("double")).withColumn("lon", clean_text(z["landing_lng"]).try_cast("double"))
    good = rows.where(F.col("site").isNotNull() & in_bbox(F.col("lat"), F.col("lon"), box))
    place = [F.format_string("%.5f", "lat"), F.format_string("%.5f", "lon")]
    one = good.groupBy(place[0].alias("y"), place[1].alias("x")).agg(
        F.min_by(F.struct("site", "title", "lat", "lon", "p"), "pos").alias("r"),
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "site"))), lambda s: s["site"]).alias("group_ids"),
    )
    given = clean_text(F.col("r.p.landing.landing_name"))
    out = one.select(
        F.concat("r.site", F.lit("-lz")).alias("id"),
        F.coalesce(F.nullif(given, F.lit("null")), F.concat("r.title", F.lit(" Landing"))).alias("name"),
        F.lit("landing").alias("role"),
        "r.lat",
        "r.lon",
        unsigned_decimal(clean_text(F.col("r.p.landing.landing_altitude"))).alias("altitude"),
        F.upper(clean_text(F.col("r.p.countryCode"))).alias("country"),
        _own_page(template, F.col("r.p.pge_link"), F.col("r.site")).alias("url"),
        clean_text(F.col("r.p.landing.landing_description")).alias("notes"),
        "group_ids",
    )
    return as_records(out, provider)


def read_nested_launches(spark: SparkSession, path: str, box: Box, provider: str = "ansg", country: str = "AU", template: str = "https://example.org/sites/{id}") -> DataFrame:
    """Launches under sites; a launch's own text wins over its site's."""
    rows = _items(spark, path, "sites", _SITE).select(F.col("item").alias("s"), F.explode("item.launches").alias("l"))
    title, part = F.coalesce(clean_text(F.col("s.name")), F.lit("Unknown site")), clean_text(F.col("l.name"))
    out = rows.where(in_bbox(F.col("l.lat"), F.col("l.lon"), box)).select(
        F.concat("s.id", F.lit("-"), "l.id").alias("id"),
        F.concat_ws(" - ", title, part).alias("name"),
        F.lit("launch").alias("role"),
        "l.lat",
        "l.lon",
        as_wind(parse_conditions(F.coalesce(clean_text(F.col("l.conditions")), F.col("s.conditions")))).alias("wind"),
        parse_height(F.col("s.height")).alias("altitude"),
        F.lit(country).alias("country"),
        F.replace(F.lit(template), F.lit("{id}"), F.col("s.id")).alias("url"),
        F.coalesce(clean_text(F.col("l.closed")), clean_text(F.col("s.closed"))).alias("closed"),
        approximate_flag(F.col("s.shortLocation")).alias("approximate_location"),
        F.array("s.id").alias("group_ids"),
    )
    return as_records(out, provider)


def read_polygon_landings(spark: SparkSession, path: str, box: Box, provider: str = "ansg", country: str = "AU", template: str = "https://example.org/sites/{id}") -> DataFrame:
    """Shapes of category Landing that a site refers to, at the mean of their vertices. Sites are in the order of their files
    and of their places in them."""
    sites = _items(spark, path, "sites", _SITE).select("pos", "item.id", clean_text(F.col("item.landing")).alias("prose"), F.posexplode("item.mapShapeIds").alias("sub", "shape"))
    spot = F.struct("pos", "sub")
    parents = sites.groupBy("shape").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "sub", "id"))), lambda x: x["id"]).alias("group_ids"),
        F.min_by("prose", F.when(F.col("prose").isNotNull(), spot)).alias("notes"),
    )
    shapes = _items(spark, path, "mapShapes", _MAP_SHAPE).where("item.category.name = 'Landing'").select("item.id", "item.name", ring_centroid(F.col("item.coordinatesList")).alias("at"))
    met = shapes.join(parents, shapes.id == parents.shape).where(in_bbox(F.col("at.lat"), F.col("at.lon"), box))
    out = met.select(
        F.concat(F.lit("lz-"), F.col("id").cast("string")).alias("id"),
        F.coalesce(clean_text(F.col("name")), F.lit("Landing")).alias("name"),
        F.lit("landing").alias("role"),
        "at.lat",
        "at.lon",
        F.lit(country).alias("country"),
        F.replace(F.lit(template), F.lit("{id}"), F.get("group_ids", F.lit(0))).alias("url"),
        "notes",
        "group_ids",
    )
    return as_records(out, provider)


def read_kml_areas(spark: SparkSession, path: str, country: str, box: Box, provider: str = "dhv", template: str = "https://example.org/details?item={id}") -> DataFrame:
    """KML placemarks; style, item number, wind and height come from their text. The place is the first
    position of a point, else of a line, a ring or an area, also inside a MultiGeometry."""
    rows = spark.read.format("xml").option("rowTag", "Placemark").schema(_PLACEMARK).load(path)
    style = F.regexp_replace(F.coalesce("styleUrl", F.lit("")), "^#+", "")
    role, tow = F.lit(None).cast("string"), F.lit(False)
    for name, (r, t) in KML_STYLES.items():
        role, tow = F.when(style == name, r).otherwise(role), F.when(style == name, F.lit(t)).otherwise(tow)
    text = F.coalesce("description", F.lit(""))
    # Fixed values of the landed files: item=<number>, "Startrichtung <compass prose>", "Höhe NN <metres> m".
    found = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    inner = {n: f"{n}.coordinates" if t == _LINE else f"{n}.outerBoundaryIs.LinearRing.coordinates" for n, t in _SHAPES.items()}
    said = F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in (*inner.values(), *[f"MultiGeometry.{c}" for c in inner.values()])])
    at = F.split(said, r"[,\s]+")
    parsed = rows.select(
        F.trim(F.coalesce("name", F.lit(""))).alias("name"),
        role.alias("role"),
        tow.alias("tow"),
        found(r"item=(\d+)").alias("item"),
        slugify(F.trim(F.coalesce("name", F.lit("")))).alias("slug"),
        F.get(at, F.lit(1)).try_cast("double").alias("lat"),
        F.get(at, F.lit(0)).try_cast("double").alias("lon"),
        as_wind(parse_conditions(german_compass(found(r"Startrichtung\s*([^<]*)")))).alias("wind"),
        found(r"Höhe NN\s*(-?\d+)\s*m").cast("double").alias("altitude"),
    )
    good = parsed.where(F.col("role").isNotNull() & F.col("item").isNotNull() & (F.col("slug") != "") & in_bbox(F.col("lat"), F.col("lon"), box))
    out = good.select(F.concat_ws("-", "item", "slug").alias("id"), "name", "role", "lat", "lon", "wind", "altitude", F.lit(country).alias("country"), F.replace(F.lit(template), F.lit("{id}"), F.col("item")).alias("url"), "tow", F.array("item").alias("group_ids"))
    return as_records(out, provider)


def union_records(guides: dict[str, tuple[Box, object]], scope: Box) -> DataFrame:
    """guides: name -> (extent, function of a box giving records). A guide outside the scope is skipped.

    Reading the result fails if a key occurs twice or is null.
    """
    parts = [make(box) for extent, make in guides.values() if (box := bbox_intersect(extent, scope))]
    if not parts:
        raise ValueError("no guide covers this scope")
    return with_unique(reduce(DataFrame.unionByName, parts))


def with_unique(records: DataFrame, column: str = "key") -> DataFrame:
    """The same rows; any read of them fails if the column repeats a value or has a null.

    The counts are summed up before they are exchanged, so what is sent is a key and a number; the verdict is one row,
    which every row's filter needs, so no optimisation leaves it out.
    """
    wrong = records.groupBy(column).agg(F.count("*").alias("n")).where(F.col(column).isNull() | (F.col("n") > 1))
    told = F.concat(F.lit(f"{column} occurs more than once or is null: "), F.col("wrong").cast("string"), F.lit(" values, such as "), F.coalesce(F.col("least").cast("string"), F.lit("null")))
    verdict = wrong.agg(F.count("*").alias("wrong"), F.min(column).alias("least")).select(F.when(F.col("wrong") == 0, True).otherwise(F.raise_error(told).cast("boolean")).alias("__unique"))
    return records.crossJoin(F.broadcast(verdict)).where("__unique").drop("__unique")  # one row


def require_unique(records: DataFrame, column: str = "key") -> None:
    twice = records.groupBy(column).count().where("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"{column} occurs twice: {[r[0] for r in twice]}")


def read_published(spark: SparkSession, path: str, precedence: tuple[str, ...]) -> DataFrame:
    """ref, lat, lon, providers, role from the published CSV; rows without source or place are skipped."""
    raw = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    have = lambda c: F.col(c) if c in raw.columns else F.lit(None).cast("string")
    rows = raw.select(decode_tokens(have("source")).alias("sources"), have("latitude").try_cast("double").alias("lat"), have("longitude").try_cast("double").alias("lon"), have("ref").alias("ref"), have("site_type").alias("site_type"))
    good = rows.where((F.size("sources") > 0) & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return good.select(F.coalesce(F.nullif("ref", F.lit("")), ref_for(F.col("sources"), precedence)).alias("ref"), "lat", "lon", F.array_sort(F.map_keys("sources")).alias("providers"), F.coalesce(F.nullif("site_type", F.lit("")), F.lit("launch")).alias("role"))


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    return checked_overrides(spark.read.schema("a string, b string, verdict string, reason string").json(path, multiLine=True))


def override_violations(rows: DataFrame) -> DataFrame:
    """a, b, verdict, problem: entries without a key, of a key with itself, with an unknown verdict or for a pair decided twice."""
    pair = rows.withColumn("low", F.least("a", "b")).withColumn("high", F.greatest("a", "b"))
    twice = pair.groupBy("low", "high").agg(F.count("*").alias("n")).where("n > 1").select(F.col("low").alias("l"), F.col("high").alias("h"), F.lit(True).alias("twice"))
    seen = pair.join(twice, F.col("low").eqNullSafe(F.col("l")) & F.col("high").eqNullSafe(F.col("h")), "left")
    blank = lambda c: F.coalesce(c, F.lit("")) == ""
    problem = (
        F.when(blank("a") | blank("b"), "missing key")
        .when(F.col("a") == F.col("b"), "a pair of one key")
        .when(~F.coalesce("verdict", F.lit("")).isin("never", "always"), "unknown verdict")
        .when(F.col("twice"), "decided twice")
    )
    return seen.select("a", "b", "verdict", problem.alias("problem")).where("problem is not null")


def checked_overrides(rows: DataFrame) -> DataFrame:
    """Fails if there is any violation."""
    wrong = override_violations(rows).limit(3).collect()
    if wrong:
        raise ValueError(f"overrides: {wrong}")
    return rows


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("key string, canonical_id string").parquet(path)


def read_run_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("source string, record_count bigint, version_id string").parquet(path)


IDENTITY = ("label", "full_name", "homepage", "site_url_template")


def guide_violations(names: DataFrame, guides: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """name, problem: guides of a run (name) that have no place in the precedence, so that their keys would follow from the
    alphabet, or that lack part of their identity in the dimension, so that their rows would go out without a label or a link."""
    blank = [F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) == "", F.lit(f"no {c}")) for c in IDENTITY]
    unranked = F.when(~F.col("name").isin(*config.precedence), F.lit("unranked"))
    found = names.select("name").distinct().join(guides.select("name", *IDENTITY), "name", "left")
    return found.select("name", F.explode(F.array_compact(F.array(unranked, *blank))).alias("problem"))


def require_guides(names: list[str], guides: DataFrame, config: Config = DEFAULT) -> None:
    """Raises before anything is read if a guide of the run is unranked or unnamed."""
    rows = guides.sparkSession.createDataFrame([(n,) for n in names], "name string")
    wrong = guide_violations(rows, guides, config).orderBy("name", "problem").collect()  # some rows for each guide
    if wrong:
        raise ValueError("guides: " + ", ".join(f"{r.name}: {r.problem}" for r in wrong))


def read_guides(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("name string, label string, full_name string, homepage string, site_url_template string, licence string, licence_url string").json(path)
