"""Queries of readers and sinks over documents that are written from the given tables, and their SQL."""

from __future__ import annotations

import contextlib

from pyspark.sql import functions as F

from siteweave.config import DEFAULT
from siteweave.functions import geo
from siteweave.operators import gates, pairs, publish, reports, select
from siteweave.plans.catalogue import (
    _CANON,
    _IDS,
    _KEYS,
    _LABEL,
    _MEMBERS,
    _PAIRS,
    _WORLD,
    RECORDS,
    _numbered,
    _with,
    last_counts,
    old_registry,
    published,
    query,
    sites,
    stated,
    wind_pairs,
)
from siteweave.plans.store import new_path, written
from siteweave.sources import derived, readers, sinks


def _documents(df, path: str, order: str, per: int, body) -> None:
    """One JSON document for each ``per`` numbers of the order column; ``body`` makes it of the sorted items."""
    one = df.groupBy(F.floor(F.col(order) / per).alias("g")).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("n"), "item"))).alias("items"))
    items = F.transform("items", lambda x: x["item"])
    one.select("g", F.to_json(body(items)).alias("value")).write.partitionBy("g").text(path)


# --- features --------------------------------------------------------------------------

@query(_with(RECORDS, """t as (select k, k // 4 g, name, altitude, country, url, id, case when k % 5 = 1 then 'null' when k % 5 <> 0 then 'Field ' || k end said, case when k % 17 = 0 then 'Mow first' end note from rec where provider = 'pge'),
f as (select g, min(k) k, string_agg(id, ';' order by k) group_ids from t where k % 11 <> 7 group by g)""") + f"""
select 'pge:' || t.id || '-lz' as "key", coalesce(nullif(said, 'null'), name || ' Landing') as name, 'landing' as role, round(-30 + t.g / 1000, 6) lat, round(115 + t.g / 1000, 6) lon, t.g::double altitude, country,
  'https://x.example.org/' || t.id url, note notes, group_ids from t join f on t.k = f.k where {_WORLD.format("-30 + t.g / 1000", "115 + t.g / 1000")}""")
def read_feature_landings(spark, sf_dir):
    """Four takeoffs share a landing; some name none."""
    df = derived.base(spark, sf_dir).where("provider = 'pge'").withColumn("g", F.floor(F.col("k") / 4))
    text = lambda c: c.cast("string")
    landing = F.struct(
        text(-30 + F.col("g") / 1000).alias("landing_lat"), text(115 + F.col("g") / 1000).alias("landing_lng"), text(F.col("g")).alias("landing_altitude"),
        F.when(F.col("k") % 5 == 1, "null").when(F.col("k") % 5 != 0, F.concat(F.lit("Field "), text(F.col("k")))).alias("landing_name"), F.when(F.col("k") % 17 == 0, " Mow first ").alias("landing_description"),
    )
    properties = F.struct(F.col("id").alias("pge_site_id"), "name", F.lower("country").alias("countryCode"), F.concat(F.lit("http://x.example.org/"), "id").alias("pge_link"), F.when(F.col("k") % 11 != 7, landing).alias("landing"))
    path = new_path(spark, "features")
    _documents(df.withColumn("item", F.struct(properties.alias("properties"))), path, "k", 1000, lambda items: F.struct(items.alias("features")))
    back = readers.read_feature_landings(spark, path, geo.WORLD)
    return back.select("key", "name", "role", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "altitude", "country", "url", "notes", F.array_join("group_ids", ";").alias("group_ids"))


@query(_with(RECORDS, """t as (select k, k % 3 f, k // 4 g, name, altitude, country, url, id from rec where provider = 'pge'),
o as (select g, arg_min(k, f * 1000000000 + k) k, string_agg(id, ';' order by f, k) group_ids from t group by g)""") + f"""
select 'pge:' || t.id || '-lz' as "key", name || ' Landing' as name, round(-30 + t.g / 1000, 6) lat, round(115 + t.g / 1000, 6) lon, country, group_ids from t join o on t.k = o.k where {_WORLD.format("-30 + t.g / 1000", "115 + t.g / 1000")}""")
def landings_of_several_files(spark, sf_dir):
    """Every landing is shared by takeoffs of three files: the first file's first takeoff names it."""
    df = derived.base(spark, sf_dir).where("provider = 'pge'").withColumn("g", F.floor(F.col("k") / 4))
    landing = F.struct((-30 + F.col("g") / 1000).cast("string").alias("landing_lat"), (115 + F.col("g") / 1000).cast("string").alias("landing_lng"))
    item = F.struct(F.struct(F.col("id").alias("pge_site_id"), "name", F.col("country").alias("countryCode"), landing.alias("landing")).alias("properties"))
    path = new_path(spark, "features")
    lists = df.groupBy((F.col("k") % 3).alias("f")).agg(F.array_sort(F.collect_list(F.struct(F.col("k"), item.alias("item")))).alias("items"))
    lists.select("f", F.to_json(F.struct(F.transform("items", lambda x: x["item"]).alias("features"))).alias("value")).write.partitionBy("f").text(path)
    back = readers.read_feature_landings(spark, path, geo.WORLD)
    return back.select("key", "name", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "country", F.array_join("group_ids", ";").alias("group_ids"))


# --- polygons --------------------------------------------------------------------------

@query("""with s as (select s_suppkey k, s_suppkey // 3 shape, case when s_suppkey % 2 = 0 then 'Stay low ' || s_suppkey end prose from supplier),
p as (select shape, arg_min(k, k) k, arg_min(prose, k) filter (prose is not null) notes, string_agg('s' || k, ';' order by k) group_ids from s group by 1)
select 'ansg:lz-' || shape as "key", case when shape % 4 = 1 then 'Landing' else 'LZ ' || shape end as name, 'landing' as role, round(-30 - shape / 1000, 6) lat, round(116 + shape / 1000, 6) lon, 'AU' country,
  'https://example.org/sites/s' || k url, notes, group_ids from p where shape % 5 <> 2""")
def read_polygon_landings(spark, sf_dir):
    """Three sites share a shape; shapes of another category and shapes that no site names are left out."""
    df = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.col("s_suppkey").alias("k"), F.floor(F.col("s_suppkey") / 3).alias("shape"))
    site = F.struct(F.concat(F.lit("s"), F.col("k").cast("string")).alias("id"), F.when(F.col("k") % 2 == 0, F.concat(F.lit(" Stay low "), F.col("k").cast("string"))).alias("landing"), F.array("shape").alias("mapShapeIds"))
    y, x = -30 - F.col("shape") / 1000, 116 + F.col("shape") / 1000
    corner = lambda dx, dy: F.concat_ws(",", F.format_string("%.6f", x + dx), F.format_string("%.6f", y + dy))
    name = F.when(F.col("shape") % 4 == 1, " ").otherwise(F.concat(F.lit("LZ "), F.col("shape").cast("string")))
    category = F.struct(F.when(F.col("shape") % 5 == 2, "Hazard").otherwise("Landing").alias("name"))
    ring = F.array(F.concat_ws(" ", corner(0.002, 0), corner(-0.002, 0.001), corner(0, -0.001), F.lit("bad")))
    shape = F.struct(F.col("shape").alias("id"), name.alias("name"), category.alias("category"), ring.alias("coordinatesList"))
    lonely = F.struct((F.col("shape") + 1_000_000).alias("id"), F.lit("unused").alias("name"), category.alias("category"), ring.alias("coordinatesList"))
    path = new_path(spark, "export")
    items = df.withColumn("item", F.struct(site.alias("site"), shape.alias("shape"), lonely.alias("lonely")))
    each = lambda items, name: F.array_distinct(F.transform(items, lambda i: i[name]))
    # 999 suppliers a document, so that a shape's sites stand in one
    _documents(items, path, "k", 999, lambda i: F.struct(each(i, "site").alias("sites"), F.concat(each(i, "shape"), each(i, "lonely")).alias("mapShapes")))
    back = readers.read_polygon_landings(spark, path, geo.WORLD)
    return back.select("key", "name", "role", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), "country", "url", "notes", F.array_join("group_ids", ";").alias("group_ids"))


# --- KML -------------------------------------------------------------------------------

@query("""select 'dhv:' || p_partkey || '-platz-' || p_partkey || '-oesch' as "key", 'Platz ' || p_partkey || ' Ösch' as name, case p_partkey % 4 when 2 then 'landing' else 'launch' end as role, 47 + (p_partkey % 1000) / 1000 lat, 10 + (p_partkey % 700) / 1000 lon,
  case p_partkey % 3 when 0 then 'NE:1;E:1;SE:1' when 1 then 'S:1' else '' end wind, case when p_partkey % 3 = 0 then (p_partkey % 2000)::double end altitude, p_partkey % 4 = 1 tow, 'DE' country,
  'https://example.org/details?item=' || p_partkey url, p_partkey::varchar group_ids from part where p_partkey % 4 <> 3 and p_partkey % 13 <> 5""")
def read_kml_areas(spark, sf_dir):
    """Places as points, lines, areas and points in a MultiGeometry; other styles and placemarks without a number are left out."""
    k = F.col("p_partkey")
    n = k.cast("string")
    place = F.concat(F.format_string("%.3f", 10 + (k % 700) / 1000), F.lit(","), F.format_string("%.3f", 47 + (k % 1000) / 1000), F.lit(",0"))
    style = F.element_at(F.array(*map(F.lit, (*readers.KML_STYLES, "other"))), (k % 4 + 1).cast("int"))
    point = F.concat(F.lit("<Point><coordinates> "), place, F.lit(" </coordinates></Point>"))
    line = F.concat(F.lit("<LineString><coordinates>"), place, F.lit(" 1,1,0</coordinates></LineString>"))
    area = F.concat(F.lit("<Polygon><outerBoundaryIs><LinearRing><coordinates>\n"), place, F.lit("\n1,1,0</coordinates></LinearRing></outerBoundaryIs></Polygon>"))
    several = F.concat(F.lit("<MultiGeometry>"), point, F.lit("</MultiGeometry>"))
    shape = F.element_at(F.array(point, line, area, several), (k % 7 % 4 + 1).cast("int"))
    said = F.when(k % 3 == 0, F.concat(F.lit("Startrichtung NO-SO<br>Höhe NN "), (k % 2000).cast("string"), F.lit(" m"))).when(k % 3 == 1, "Startrichtung S").otherwise("")
    number = F.when(k % 13 != 5, F.concat(F.lit("<a href='x?item="), n, F.lit("'>"))).otherwise("")
    mark = F.concat(F.lit("<Placemark><name> Platz "), n, F.lit(" Ösch </name><styleUrl>#"), style, F.lit("</styleUrl><description><![CDATA["), number, said, F.lit("]]></description>"), shape, F.lit("</Placemark>"))
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").groupBy(F.floor(k / 1000).alias("g")).agg(F.array_join(F.collect_list(mark), "\n").alias("marks"))
    path = new_path(spark, "kml")
    parts.select("g", F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<kml xmlns="http://www.opengis.net/kml/2.2"><Document>\n'), "marks", F.lit("\n</Document></kml>")).alias("value")).write.partitionBy("g").text(path)
    back = readers.read_kml_areas(spark, path, "DE", geo.WORLD)
    return back.select("key", "name", "role", "lat", "lon", wind_pairs(F.col("wind")).alias("wind"), "altitude", "tow", "country", "url", F.array_join("group_ids", ";").alias("group_ids"))


# --- small files of the job ---------------------------------------------------------------

_BAD = """bad as (select 'pge:' || c_custkey a, case c_custkey % 50 when 0 then '' when 1 then 'pge:' || c_custkey else 'dhv:' || c_custkey end b, case when c_custkey % 50 = 2 then 'maybe' when c_custkey % 2 = 0 then 'never' else 'always' end verdict from customer
  union all select 'dhv:' || c_custkey, 'pge:' || c_custkey, 'never' from customer where c_custkey % 50 = 3)"""


@query(_with(_BAD) + """select a, b, verdict, problem from (select *, case when b = '' then 'missing key' when a = b then 'a pair of one key' when verdict = 'maybe' then 'unknown verdict'
  when count(*) over (partition by least(a, b), greatest(a, b)) > 1 then 'decided twice' end problem from bad) where problem is not null""")
def override_violations(spark, sf_dir):
    k = F.col("c_custkey")
    own, other = F.concat(F.lit("pge:"), k.cast("string")), F.concat(F.lit("dhv:"), k.cast("string"))
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    first = df.select(own.alias("a"), F.when(k % 50 == 0, "").when(k % 50 == 1, own).otherwise(other).alias("b"), F.when(k % 50 == 2, "maybe").when(k % 2 == 0, "never").otherwise("always").alias("verdict"))
    again = df.where(k % 50 == 3).select(other.alias("a"), own.alias("b"), F.lit("never").alias("verdict"))
    return readers.override_violations(first.union(again))


@query("""select 'pge:' || c_custkey a, 'dhv:' || c_custkey b, case when c_custkey % 2 = 0 then 'never' else 'always' end verdict, 'seen ' || c_name reason from customer""")
def read_overrides(spark, sf_dir):
    k = F.col("c_custkey")
    n = k.cast("string")
    entry = F.struct(F.concat(F.lit("pge:"), n).alias("a"), F.concat(F.lit("dhv:"), n).alias("b"), F.when(k % 2 == 0, "never").otherwise("always").alias("verdict"), F.concat(F.lit("seen "), "c_name").alias("reason"))
    path = new_path(spark, "overrides")
    listed = spark.read.parquet(f"{sf_dir}/customer.parquet").groupBy(F.floor(k / 1000).alias("g")).agg(F.to_json(F.collect_list(entry)).alias("value"))
    listed.write.partitionBy("g").text(path)
    return readers.read_overrides(spark, path).select("a", "b", "verdict", "reason")


@query(_with(RECORDS, _IDS) + """select "key", canonical_id from rec join ids on ids.cluster_id = role || ':' || slot""")
def read_registry(spark, sf_dir):
    clusters, old = derived.slot_clusters(spark, sf_dir), old_registry(spark, sf_dir)
    path = new_path(spark, "registry")
    select.save_registry(clusters, select.assign_ids(clusters, old, 999990), old).write.parquet(path)
    return readers.read_registry(spark, path)


@query(_with(RECORDS) + "select provider source, count(*) record_count, null::varchar version_id from rec group by 1")
def read_run_state(spark, sf_dir):
    path = new_path(spark, "state")
    state = gates.save_run_state(gates.source_stats(derived.records(spark, sf_dir)), last_counts(spark, sf_dir), list(DEFAULT.precedence), {"ansg_before": "ansg"})
    state.write.parquet(path)
    return readers.read_run_state(spark, path)


@query(_with(RECORDS) + """select provider source, count(*) record_count, case provider when 'pge' then 'v' || count(*) when 'ansg' then 's' || (select count(*) from supplier) end version_id from rec group by 1""")
def run_state_versions(spark, sf_dir):
    """A version of this run, one carried from before under a former name, a guide without one and a retired guide's."""
    suppliers = spark.read.parquet(f"{sf_dir}/supplier.parquet").agg(F.concat(F.lit("s"), F.count("*").cast("string")).alias("had"))
    had = F.when(F.col("source") == "ansg_before", F.col("had")).when(F.col("source") == "retired", "old")
    state = last_counts(spark, sf_dir).crossJoin(suppliers).withColumn("version_id", had)
    stats = gates.source_stats(derived.records(spark, sf_dir))
    versions = stats.where("provider = 'pge'").select(F.col("provider").alias("source"), F.concat(F.lit("v"), F.col("record_count").cast("string")).alias("version_id"))
    return gates.save_run_state(stats, state, list(DEFAULT.precedence), {"ansg_before": "ansg"}, versions)


_GUIDES = """guides as (select case n_nationkey when 0 then 'pge' when 1 then 'ansg' when 2 then 'dhv' else 'g' || n_nationkey end as name, n_name "label", n_name || ' guide' full_name, 'https://' || lower(n_name) || '.example.org' homepage,
  'https://example.org/' || lower(n_name) || '?item={id}' site_url_template, 'CC' licence, null::varchar licence_url from nation)"""


def guide_dimension(spark, sf_dir):
    """A guide for each nation."""
    k, low = F.col("n_nationkey"), F.lower("n_name")
    name = F.when(k < len(DEFAULT.precedence), F.element_at(F.array(*map(F.lit, DEFAULT.precedence)), F.least(k + 1, F.lit(len(DEFAULT.precedence))).cast("int"))).otherwise(F.concat(F.lit("g"), k.cast("string")))
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        name.alias("name"), F.col("n_name").alias("label"), F.concat("n_name", F.lit(" guide")).alias("full_name"), F.concat(F.lit("https://"), low, F.lit(".example.org")).alias("homepage"),
        F.concat(F.lit("https://example.org/"), low, F.lit("?item={id}")).alias("site_url_template"), F.lit("CC").alias("licence"), F.lit(None).cast("string").alias("licence_url"),
    )


@query(_with(_GUIDES) + "select * from guides")
def read_guides(spark, sf_dir):
    """write_guides and read_guides"""
    path = new_path(spark, "guides")
    sinks.write_guides(guide_dimension(spark, sf_dir), path)
    return readers.read_guides(spark, path)


@query(_with(RECORDS, _MEMBERS, _CANON, _GUIDES) + """select ref, guides.name provider, replace(site_url_template, '{id}', list_filter(string_split(site_group, ';'), lambda g: string_split(g, ':')[1] = guides.name)[1][length(guides.name) + 2:]) page
from site join guides on list_contains(list_transform(string_split(site_group, ';'), lambda g: string_split(g, ':')[1]), guides.name)""")
def source_page_url(spark, sf_dir):
    return select.source_pages(sites(spark, sf_dir), guide_dimension(spark, sf_dir))


@query("""with g as (select n_nationkey k, case n_nationkey when 0 then 'pge' when 1 then 'ansg' when 2 then 'dhv' else 'g' || n_nationkey end as name from nation)
select name, 'unranked' problem from g where k > 2 union all select name, 'no label' from g where k % 4 = 1 union all select name, 'no homepage' from g where k % 5 = 2
union all select name, 'no full_name' from g where k % 6 = 0 union all select name, 'no label' from g where k % 6 = 0 and k % 4 <> 1 union all select name, 'no homepage' from g where k % 6 = 0 and k % 5 <> 2
union all select name, 'no site_url_template' from g where k % 6 = 0""")
def guide_checks(spark, sf_dir):
    """A guide for each nation: most are unranked, some have a blank label or homepage, some are not in the dimension at all."""
    rows = guide_dimension(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.col("n_name").alias("label"), F.col("n_nationkey").alias("k")), "label")
    k = F.col("k")
    known = rows.where(k % 6 != 0).withColumn("label", F.when(k % 4 == 1, "  ").otherwise(F.col("label"))).withColumn("homepage", F.when(k % 5 != 2, F.col("homepage")))
    return readers.guide_violations(rows.select("name"), known)


# --- shards, counts and gates ---------------------------------------------------------------

@query(_with(RECORDS, _MEMBERS, _CANON, "c as (select coalesce(country, 'xx') country, bool_or(low like 'pge:%33') changed from site group by 1)") + """
select (select count(*) from c) countries, (select count(*) from c where changed) written, (select count(*) from c where not changed) unchanged, 1 removed, (select count(*) from site) sites""")
def shard_totals(spark, sf_dir):
    """The old set has some other names and one country more."""
    new = _numbered(spark, sf_dir)
    low = derived.slot_clusters(spark, sf_dir).groupBy("cluster_id").agg(F.min("key").alias("low"))
    old = new.join(low, "cluster_id").withColumn("name", F.when(F.col("low").like("pge:%33"), F.concat("name", F.lit("?"))).otherwise(F.col("name"))).drop("low")
    gone = old.where("country = 'AU'").withColumn("country", F.lit("GONE"))
    return sinks.shard_totals(new, old.unionByName(gone))


@query(_with(RECORDS, """new as (select "key" ref, provider, role from rec), old as (select * from new where provider <> 'ansg' and role <> 'landing'),
t as (select (select count(distinct ref) from old) was, (select count(distinct ref) from new) now, (select count(*) from new where provider not in (select provider from old) or role not in (select role from old)) accounted)""") + """
select 'count' gate, round(abs((now - was) / was - case when now > was then accounted / was else 0 end), 6) <= 0.05 ok, round(abs((now - was) / was - case when now > was then accounted / was else 0 end), 6) "value", 0.05::double "limit", was || ' -> ' || now detail from t""")
def gate_count_growth(spark, sf_dir):
    """A guide and a role that were never published before explain the growth."""
    new = published(spark, sf_dir, False)
    old = new.where("not array_contains(providers, 'ansg') and role <> 'landing'")
    return gates.gate_count(new, old)


@query("""with c as (select c_custkey k, c_custkey // 8 b, c_custkey % 8 i from customer) select 'c' || k cluster_id, 'SITE-' || printf('%06d', k + 1) canonical_id, false is_new from c""")
def assign_ids_contested(spark, sf_dir):
    """Chains of eight clusters, each of which knows its own id and that of the cluster before it."""
    k = F.col("c_custkey")
    key = F.format_string("%08d", k)
    clusters = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("c"), k.cast("string")).alias("cluster_id"), F.explode(F.array(F.concat(key, F.lit("a")), F.concat(key, F.lit("b")))).alias("key"), "c_custkey")
    n = F.when(F.col("key").endswith("a") | (k % 8 == 0), k + 1).otherwise(k)
    registry = clusters.select("key", F.concat(F.lit("SITE-"), F.format_string("%06d", n)).alias("canonical_id"))
    return select.assign_ids(clusters.select("cluster_id", "key"), registry, 2_000_000)


@query("""with c as (select c_custkey k, c_custkey % 200 i from customer),
p as (select c.k, i, case when i = 199 then row_number() over (partition by i = 199 order by c.k) end late from c)
select 'c' || k cluster_id, 'SITE-' || printf('%06d', case when i = 199 then 2000000 - 1 + late else k + 1 end) canonical_id, i = 199 is_new from p""")
def assign_ids_chains(spark, sf_dir):
    """Chains of two hundred clusters: each knows its own id and that of the cluster before it, the last knows only the latter."""
    k = F.col("c_custkey")
    key = F.format_string("%08d", k)
    clusters = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.concat(F.lit("c"), k.cast("string")).alias("cluster_id"), F.explode(F.array(F.concat(key, F.lit("a")), F.concat(key, F.lit("b")))).alias("key"), "c_custkey")
    n = F.when((k % 200 != 199) & (F.col("key").endswith("a") | (k % 200 == 0)), k + 1).otherwise(k)
    first = clusters.agg(F.min(k).alias("first"))  # a chain may begin after its first cluster
    known = clusters.crossJoin(first).where((n > F.col("first")) | (k % 200 == 0))
    registry = known.select("key", F.concat(F.lit("SITE-"), F.format_string("%06d", n)).alias("canonical_id"))
    return select.assign_ids(clusters.select("cluster_id", "key"), registry, 2_000_000)


@query(_with(RECORDS, _MEMBERS, _CANON, _IDS) + """select coalesce(lower(country), 'xx') shard, canonical_id id, name, round(lat, 6) lat, round(lon, 6) lon, role, "primary", wind, source, site_group, altitude, country, url, closed, notes, tow from site join ids using (cluster_id)""")
def country_shard_bodies(spark, sf_dir):
    """The shards that were written, read back field by field."""
    path = new_path(spark, "shards")
    sinks.write_country_shards(_numbered(spark, sf_dir), path)
    schema = "id string, name string, lat double, lon double, wind map<string,int>, sources map<string,string>, primary string, role string, tow boolean, group array<string>, altitude double, country string, url string, closed string, notes string"
    back = spark.read.schema("value string, country string").text(path).select(F.col("country").alias("shard"), F.from_json("value", schema).alias("r"))
    source = F.array_join(F.array_sort(F.transform(F.map_entries("r.sources"), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))), ";")
    plain = ["id", "name", "lat", "lon", "role", "primary", "altitude", "country", "url", "closed", "notes", "tow"]
    return back.select("shard", *[f"r.{c}" for c in plain], wind_pairs(F.col("r.wind")).alias("wind"), source.alias("source"), F.array_join("r.group", ";").alias("site_group"))


# --- overrides and duplicates by entry ------------------------------------------------------

_ENTRY = """dec2 as (select *, case when substr(verdict, 1, 1) = 'n' then 'far | apart' end reason from dec),
ent as (select verdict, row_number() over (partition by verdict order by a, b) nth, least(a, b) low, greatest(a, b) high, coalesce(replace(reason, '|', '\\|'), '—') reason from dec2)"""


@query(_with(RECORDS, _PAIRS, _KEYS, _ENTRY) + f"""select verdict, nth, coalesce({_LABEL.format("x")}, '`' || low || '`') "first", coalesce({_LABEL.format("y")}, '`' || high || '`') "second", reason,
  case when x."key" is null or y."key" is null then 'stale' else 'yes' end status from ent left join rec x on x."key" = low left join rec y on y."key" = high""")
def override_entries(spark, sf_dir):
    """Every entry with its names, in order; some reasons hold a mark that would break a table, some are missing."""
    said = stated(spark, sf_dir).withColumn("reason", F.when(F.col("verdict") == "never", "far | apart"))
    return reports.override_entries(said, derived.records(spark, sf_dir))


@query(_with(RECORDS, _PAIRS) + "select pa provider, count(*) n from near where pa = pb and ia < ib and ga <> gb and m <= 250 group by 1")
def duplicate_counts(spark, sf_dir):
    return reports.duplicate_counts(pairs.same_source_pairs(derived.records(spark, sf_dir)))


# --- publishing ---------------------------------------------------------------------------

def _renamed(spark, sf_dir, rows, tail):
    """The sites whose smallest key ends so have another name."""
    low = derived.slot_clusters(spark, sf_dir).groupBy("cluster_id").agg(F.min("key").alias("low"))
    return rows.join(low, "cluster_id").withColumn("name", F.when(F.col("low").like(f"pge:%{tail}"), F.concat("name", F.lit("?"))).otherwise(F.col("name"))).drop("low")


@query(_with(RECORDS, _MEMBERS, _CANON, "c as (select lower(coalesce(country, 'xx')) country, bool_or(low like 'pge:%33') changed from site group by 1)") + """
select country, case when changed then 'written' else 'unchanged' end status, not changed files_kept from c union all select 'gone', 'removed', false""")
def shards_written_again(spark, sf_dir):
    """The second write over the first: which shards' files are still the same ones."""
    path = new_path(spark, "shards")
    new = _numbered(spark, sf_dir)
    old = _renamed(spark, sf_dir, new, "33")
    sinks.write_country_shards(old.unionByName(old.where("country = 'AU'").withColumn("country", F.lit("GONE"))), path)
    files = lambda: spark.read.schema("value string, country string").text(path).groupBy("country").agg(F.array_sort(F.collect_set("_metadata.file_name")).alias("names"), F.max("_metadata.file_modification_time").alias("time"))
    before = written(files(), "before")
    status = sinks.write_country_shards(new, path)
    same = before.join(files().select("country", F.col("names").alias("n2"), F.col("time").alias("t2")), "country", "left").select("country", F.coalesce((F.col("names") == F.col("n2")) & (F.col("time") == F.col("t2")), F.lit(False)).alias("files_kept"))
    return status.join(same, "country")


@query(_with(RECORDS, _MEMBERS, _CANON, _IDS, "c as (select *, lower(coalesce(country, 'xx')) shard, low like 'pge:%33' changed from site)") + """
select shard, canonical_id id, name, 1 + max(changed::int) over (partition by shard) "run" from c join ids using (cluster_id)""")
def published_catalogue(spark, sf_dir):
    """Published twice, the second time with some names changed, and then refused: what readers see, and the run that wrote it."""
    root = new_path(spark, "root")
    new = _numbered(spark, sf_dir)
    publish.publish(_renamed(spark, sf_dir, new, "33"), root)
    publish.publish(new, root)
    with contextlib.suppress(ValueError):
        publish.publish(new.where("role = 'landing'"), root)  # too few rows: the gates refuse
    rows = publish.read_shards(spark, root).select(F.col("country").alias("shard"), F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.name").alias("name"))
    runs = publish.manifest(spark, root).select(F.col("country").alias("shard"), F.regexp_extract("folder", "^runs/0*([0-9]+)", 1).cast("int").alias("run"))
    return rows.join(runs, "shard").select("shard", "id", "name", "run")


@query(_with(RECORDS, """t as (select lat, lon, degrees(400 / 6371000.0::double) * 1.02 step from rec),
b as (select lon, step, floor(lat / step)::bigint band from t),
c as (select band, greatest(floor(360.0 * cos(radians(least(greatest(abs(band * step), abs((band + 1) * step)), 90.0))) / step), 1)::bigint cells, lon from b),
d as (select band, floor((lon + 180.0) / 360.0 * cells)::bigint % cells cell, count(*) n from c group by 1, 2)""") + """select band, cell, n, least(ceil(sqrt(n / 3)), 64)::int cuts from d where n > 3""")
def crowded_cells(spark, sf_dir):
    """Cells of 400 m with more than three records, and how often they are cut."""
    return pairs.crowded_cells(derived.records(spark, sf_dir), 400.0, 3)


@query(_with(RECORDS, _PAIRS) + "select * from pairs")
def pairs_of_cut_cells(spark, sf_dir):
    """All cells that hold more than one record are cut again: the same pairs."""
    return pairs.candidate_pairs(derived.records(spark, sf_dir), crowd=1)
