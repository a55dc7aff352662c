"""The catalogue's queries over the given tables, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from siteweave.config import DEFAULT, DIRECTIONS
from siteweave.functions import geo, text, wind
from siteweave.operators import gates, pairs, reports, resolve, select
from siteweave.plans.store import discard, new_path, written
from siteweave.sources import derived, readers, sinks
from siteweave.sources.derived import base_sql, records

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


# --- pieces of SQL ---------------------------------------------------------------------

_WIND = " || ".join(f"case when list_contains(string_split(said, ','), '{d}') then ';{d}:1' else '' end" for d in DIRECTIONS)
_SAID = "case prose " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(derived.PROSE.values())) + " end"
RECORDS = f"""base as ({base_sql()}), said as (select *, {_SAID} said from base),
rec as (select * exclude (rkey), rkey as "key", coalesce(grades, ltrim({_WIND}, ';')) wind from said)"""
_HAV = "2 * 6371000.0 * asin(sqrt(least(1.0, pow(sin(radians({b}lat - {a}lat) / 2), 2) + cos(radians({a}lat)) * cos(radians({b}lat)) * pow(sin(radians({b}lon - {a}lon) / 2), 2))))"
_PAIRS = f"""near as (select a."key" key_a, b."key" key_b, a.provider pa, b.provider pb, a.id ia, b.id ib, a.gid ga, b.gid gb, a.role ra, b.role rb,
    a.approximate_location or b.approximate_location vague, {_HAV.format(a="a.", b="b.")} m
  from rec a join rec b on a.role = b.role and abs(a.lat - b.lat) < 0.004 and abs(a.lon - b.lon) < 0.006 where a."key" <> b."key"),
pairs as (select key_a, key_b, round(m, 1) distance_m, case when m <= 250 and not vague then 'MERGE' else 'REVIEW' end band
  from near where pa <> pb and key_a < key_b and m <= 400)"""
_MEMBERS = """mem as (select *, role || ':' || slot cluster_id from rec),
ctry as (select cluster_id, count(distinct country) n, min(country) lowest, arg_min(country, "key") filter (provider <> 'pge' and country is not null) national from mem group by cluster_id),
cc as (select cluster_id, case when n <= 1 then lowest else coalesce(national, lowest) end cluster_country, n > 1 conflict from ctry),
tier as (select mem.*, cluster_country, case when (provider = 'ansg' and cluster_country = 'AU') or (provider = 'dhv' and cluster_country in ('DE', 'AT', 'CH')) then 0 when provider = 'pge' then 1 else 2 end tier from mem join cc using (cluster_id)),
ranked as (select *, row_number() over (partition by cluster_id order by tier, provider, "key") rnk from tier)"""
_CANON = """src as (select cluster_id, provider, arg_max(id, rnk) id from ranked group by all),
srcs as (select cluster_id, string_agg(provider || ':' || id, ';' order by provider || ':' || id) source, min(provider) first_p,
   max(case when provider = 'pge' then id end) pge, max(case when provider = 'ansg' then id end) ansg, max(case when provider = 'dhv' then id end) dhv,
   count(*) n_sources from src group by cluster_id),
canon as (select cluster_id, arg_min(name, rnk) name, arg_min(lat, rnk) lat, arg_min(lon, rnk) lon, arg_min(role, rnk) role, arg_min(url, rnk) url, arg_min(provider, rnk) "primary",
   case when arg_min(role, rnk) = 'landing' then '' else coalesce(arg_min(wind, rnk) filter (wind <> ''), '') end wind,
   arg_min(altitude, rnk) filter (altitude is not null) altitude, arg_min(notes, rnk) filter (notes is not null) notes, arg_min(closed, rnk) filter (closed is not null) closed,
   bool_or(tow) tow, string_agg(distinct provider || ':' || gid, ';' order by provider || ':' || gid) site_group, any_value(cluster_country) country, min("key") low
  from ranked group by cluster_id),
site as (select canon.*, source, n_sources, pge, ansg, dhv, case when pge is not null then 'pge:' || pge when ansg is not null then 'ansg:' || ansg else 'dhv:' || dhv end ref from canon join srcs using (cluster_id))"""


#: Readers take places inside their box, here the world: the copies of larger tables reach beyond it.
_WORLD = "{0} between -90 and 90 and {1} between -180 and 180"


def similarity_sql(pairs: str) -> str:
    """CTEs that end in sim (i, similarity) for the rows (i, a, b) of a query: the longest common subsequence is
    counted on the bits of one number."""
    return f"""ask as ({pairs}),
tok as (select i, list_distinct(list_filter(regexp_split_to_array(a, '\\s+'), lambda t: t <> '')) x, list_distinct(list_filter(regexp_split_to_array(b, '\\s+'), lambda t: t <> '')) y from ask where a <> '' and b <> ''),
prt as (select i, x, y, array_to_string(list_sort(list_filter(x, lambda t: list_contains(y, t))), ' ') s,
  array_to_string(list_sort(list_filter(x, lambda t: not list_contains(y, t))), ' ') p, array_to_string(list_sort(list_filter(y, lambda t: not list_contains(x, t))), ' ') q from tok),
msk as (select *, list_transform(string_split(p, ''), lambda c: coalesce(list_sum(list_transform(range(length(q)), lambda j: case when q[j + 1] = c then 1::hugeint << j::int else 0::hugeint end)), 0)::hugeint) m from prt),
lcs as (select *, length(q) - bit_count(list_reduce(list_prepend((1::hugeint << length(q)::int) - 1, m), lambda v, w: (v + (v & w)) | (v - (v & w))) & ((1::hugeint << length(q)::int) - 1)) n from msk),
len as (select *, length(s) ls, case when s = '' then 0 else 1 end g, length(p) lp, length(q) lq from lcs),
sim as (select i, case when len(x) = 0 or len(y) = 0 then 0.0 when s <> '' and (p = '' or q = '') then 100.0 else greatest(100 - 100.0::double * (lp + lq - 2 * n) / (2 * ls + 2 * g + lp + lq),
  case when s <> '' then 100 - 100.0::double * (g + lp) / (2 * ls + g + lp) end, case when s <> '' then 100 - 100.0::double * (g + lq) / (2 * ls + g + lq) end) end similarity from len)"""


def _with(*parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n"


def wind_pairs(w):
    """Map to text in compass order."""
    names = F.filter(F.array(*map(F.lit, DIRECTIONS)), lambda d: F.map_contains_key(w, d))
    return F.array_join(F.transform(names, lambda d: F.concat(d, F.lit(":"), F.element_at(w, d).cast("string"))), ";")


def members(spark, sf_dir):
    return select.members(records(spark, sf_dir), derived.slot_clusters(spark, sf_dir))


def sites(spark, sf_dir):
    return select.select_canonical(members(spark, sf_dir))


# --- records and pairs -----------------------------------------------------------------

@query(_with(RECORDS) + f"""select provider, id, "key", name, role, lat, lon, wind, altitude, country, url, closed, notes, tow, approximate_location, gid group_ids from rec where {_WORLD.format("lat", "lon")}""")
def union_records(spark, sf_dir):
    return _as_text(readers.union_records({g: (geo.WORLD, _guide(spark, sf_dir, g)) for g in DEFAULT.precedence}, geo.WORLD))


def _as_text(df):
    return df.withColumn("wind", wind_pairs(F.col("wind"))).withColumn("group_ids", F.array_join("group_ids", ";"))


def _guide(spark, sf_dir, name):
    """A guide's reader: its records inside a box."""
    return lambda box: records(spark, sf_dir).where(F.col("provider") == name).where(geo.in_bbox(F.col("lat"), F.col("lon"), box))


@query(_with(RECORDS) + """select provider, id, "key", name, role, lat, lon, wind, altitude, country, url, closed, notes, tow, approximate_location, gid group_ids from rec
where provider = 'pge' and lat between -60 and -29 and lon between 100 and 180 or provider = 'ansg' and lat between -45 and -29 and lon between 110 and 155""")
def union_in_scope(spark, sf_dir):
    """A guide whose extent misses the scope is skipped, the others are read inside it."""
    extents = {"pge": geo.WORLD, "ansg": geo.Box(-45.0, 110.0, -10.0, 155.0), "dhv": geo.Box(45.0, 5.0, 55.0, 17.0)}
    return _as_text(readers.union_records({g: (box, _guide(spark, sf_dir, g)) for g, box in extents.items()}, geo.Box(-60.0, 100.0, -29.0, 180.0)))


@query(_with(RECORDS, _PAIRS) + "select * from pairs")
def candidate_pairs(spark, sf_dir):
    return pairs.candidate_pairs(records(spark, sf_dir))


@query(_with(RECORDS, _PAIRS) + "select pa provider, key_a, key_b, round(m, 1) distance_m from near where pa = pb and ia < ib and ga <> gb and m <= 250")
def same_source_pairs(spark, sf_dir):
    return pairs.same_source_pairs(records(spark, sf_dir))


@query(_with(RECORDS) + """select distinct a."key" landing, b."key" launch from rec a join rec b on a.role = 'landing' and b.role = 'launch' and a.provider = b.provider and a.gid = b.gid""")
def landing_launches(spark, sf_dir):
    df = records(spark, sf_dir)
    return pairs.landing_launches(df.select("key", "role", F.transform("group_ids", lambda g: F.concat("provider", F.lit(":"), g)).alias("tokens")))


@query(_with(RECORDS) + f"""select provider, count(*) landings, quantile_disc(m, 0.5) median_m, quantile_disc(m, 0.9) p90_m, count(*) filter (m <= 250) "within"
from (select a."key", a.provider, min(round({_HAV.format(a="a.", b="b.")}, 1)) m from rec a join rec b on a.role = 'landing' and b.role = 'launch' and a.provider = b.provider and a.gid = b.gid group by all) group by provider""")
def landing_gaps(spark, sf_dir):
    return reports.landing_gaps(records(spark, sf_dir))


_NEAREST = f"""mine as (select * from rec where role = 'launch' and country in ('DE','AT','CH') and provider = 'dhv'),
others as (select * from rec where role = 'launch' and country in ('DE','AT','CH') and provider <> 'dhv'),
hits as (select a."key" mk, b."key" other, {_HAV.format(a="a.", b="b.")} m from mine a join others b on abs(a.lat - b.lat) < 0.01 and abs(a.lon - b.lon) < 0.015),
top as (select *, row_number() over (partition by mk order by m, other) rnk from hits where m <= 1000 qualify rnk <= 2)"""


@query(_with(RECORDS, _NEAREST) + """select "key", rnk as rank, other, round(m, 1) distance_m from mine left join top on mk = "key" """)
def nearest_counterparts(spark, sf_dir):
    near = pairs.nearest_counterparts(records(spark, sf_dir), "dhv", ["de", "at", "ch"])
    return near.select("key", "rank", "other", F.round("meters", 1).alias("distance_m"))


_BANDS = "case " + " ".join(f"when m < {b} then {b}" for b in reports.BANDS) + " end"


@query(_with(RECORDS, _NEAREST, f"""firsts as (select {_BANDS} band, count(*) n from mine left join top on mk = "key" and rnk = 1 group by 1),
e as (select unnest([{", ".join(map(str, reports.BANDS))}, null]) band)""") + "select e.band, coalesce(n, 0) n, (select count(*) from top where rnk = 2 and m < 250) ambiguous from e left join firsts on e.band is not distinct from firsts.band")
def calibration_histogram(spark, sf_dir):
    return reports.calibration_histogram(records(spark, sf_dir), "dhv", ["DE", "AT", "CH"])


@query(_with(RECORDS, _NEAREST) + """select side, mk as "key", other, round(m, 1) distance_m from (select *, case when m >= 150 and m < 250 then 'inside' when m >= 250 and m < 400 then 'outside' end side from top where rnk = 1)
where side is not null qualify row_number() over (partition by side order by m, mk) <= 12""")
def calibration_samples(spark, sf_dir):
    return reports.calibration_samples(records(spark, sf_dir), "dhv", ["DE", "AT", "CH"])


# --- resolution --------------------------------------------------------------------------

def clusters_sql(decisions: bool) -> str:
    """CTEs that end in clus (key, cluster_id); with decisions, those of dec count."""
    never = "where not exists (select 1 from dec where verdict = 'never' and least(a, b) = key_a and greatest(a, b) = key_b)" if decisions else ""
    forced = """union all select distinct least(a, b), greatest(a, b), null, 'FORCED', true from dec where verdict = 'always' and a in (select "key" from rec) and b in (select "key" from rec)""" if decisions else ""
    return f"""known as (select key_a, key_b, distance_m, band, false forced from pairs {never} {forced}),
edge as (select key_a x, key_b y from known where band <> 'REVIEW' union select key_b, key_a from known where band <> 'REVIEW'),
reach as (select x, x r from edge union select edge.y, reach.r from reach join edge on edge.x = reach.x where edge.y > reach.r),
top as (select x, min(r) r from reach group by x),
deep as (select x, r from top union select edge.y, deep.r from deep join edge on edge.x = deep.x join top on top.x = edge.y where deep.r < top.r),
root as (select x, min(r) r from deep group by x),
inside as (select known.*, a.r from known join root a on a.x = key_a join root b on b.x = key_b and a.r = b.r),
step as (select *, row_number() over (partition by r order by forced desc, distance_m, key_a, key_b) n from inside where band <> 'REVIEW'),
may as (select r, list(key_a || ' ' || key_b) ok from inside where forced or distance_m <= 250 group by r),
walk as (select r, 0::bigint n, list([x]) c from root group by r
  union all select r, n, case when px <> py and len(list_filter(flatten(list_transform(px, lambda p: list_transform(py, lambda q: least(p, q) || ' ' || greatest(p, q)))), lambda z: list_contains(ok, z))) >= case when forced then 0 else len(px) * len(py) end
    then list_append(list_filter(c, lambda z: z <> px and z <> py), px || py) else c end
  from (select w.r, s.n, w.c, s.forced, m.ok, list_filter(w.c, lambda z: list_contains(z, s.key_a))[1] px, list_filter(w.c, lambda z: list_contains(z, s.key_b))[1] py
    from walk w join step s on s.r = w.r and s.n = w.n + 1 join may m on m.r = w.r)),
done as (select r, arg_max(c, n) c from walk group by r),
put as (select unnest(g) pk, list_min(g) cluster_id from (select unnest(c) g from done)),
clus as (select "key", coalesce(cluster_id, "key") cluster_id from rec left join put on pk = "key")"""


def _recursive(*parts: str) -> str:
    return _with(*parts).replace("with ", "with recursive ", 1)


@query(_recursive(RECORDS, _PAIRS, clusters_sql(False)) + "select * from clus")
def cluster_records(spark, sf_dir):
    df = records(spark, sf_dir)
    return resolve.cluster_records(df, pairs.candidate_pairs(df))


@query()
def cluster_with_overrides(spark, sf_dir):
    df = records(spark, sf_dir)
    return resolve.cluster_records(df, pairs.candidate_pairs(df), stated(spark, sf_dir))


_MEM = "mem as (select *, role || ':' || slot cluster_id from rec)"


@query(_recursive(RECORDS, _PAIRS, clusters_sql(False), _MEMBERS.replace(_MEM, "mem as (select rec.*, clus.cluster_id from rec join clus using (\"key\"))"), _CANON) + """
select 'SITE-' || printf('%06d', row_number() over (order by cluster_id)) canonical_id, ref, name, role, lat, lon, "primary", country, wind, source from site""")
def canonical_catalogue(spark, sf_dir):
    """The whole way: pairs, clusters, selection, ids."""
    df = records(spark, sf_dir)
    clusters = resolve.cluster_records(df, pairs.candidate_pairs(df))
    rows = select.select_canonical(select.members(df, clusters))
    ids = select.assign_ids(clusters, clusters.select("key", F.lit("").alias("canonical_id")).limit(0), 1)
    return rows.join(ids, "cluster_id").select("canonical_id", "ref", "name", "role", "lat", "lon", "primary", "country", wind_pairs(F.col("wind")).alias("wind"), text.encode_tokens(F.col("sources")).alias("source"))


_SIZES = """own as (select "key", case when k % 2 = 0 then role || ':' || slot else "key" end c from rec),
sized as (select "key", c, count(*) over (partition by c) > 1 multi from own),
j as (select p.*, a.c ca, b.c cb, a.multi ma, b.multi mb from pairs p join sized a on a."key" = key_a join sized b on b."key" = key_b)"""


@query(_with(RECORDS, _PAIRS, _SIZES) + """select key_a, key_b, distance_m, band, case when band = 'REVIEW' then 'beyond merge threshold' when ma or mb then 'counterpart already merged' else 'would over-merge the cluster' end reason
from j where ca <> cb and not (ma and mb)""")
def review_items(spark, sf_dir):
    """On clusters that only the even half of the records joins."""
    return resolve.review_items(pairs.candidate_pairs(records(spark, sf_dir)), _halves(spark, sf_dir))


def _halves(spark, sf_dir):
    return derived.base(spark, sf_dir).select(F.col("rkey").alias("key"), F.when(F.col("k") % 2 == 0, F.concat_ws(":", "role", F.col("slot").cast("string"))).otherwise(F.col("rkey")).alias("cluster_id"))


_KEYS = """dec as (select key_b a, key_a b, case (ascii(key_a) + length(key_a) + length(key_b) * 3 + cast(distance_m * 10 as bigint)) % 5 when 0 then 'never' else 'always' end verdict from pairs
  where (ascii(key_a) + length(key_a) + length(key_b) * 3 + cast(distance_m * 10 as bigint)) % 5 < 2
  union all select 'pge:gone-' || n_name, 'dhv:gone', 'always' from nation)"""


def stated(spark, sf_dir, found=None):
    """Overrides made from the pairs by arithmetic that SQL repeats, and some for keys that don't exist."""
    found = pairs.candidate_pairs(records(spark, sf_dir)) if found is None else found
    n = F.expr("(ascii(key_a) + length(key_a) + length(key_b) * 3 + cast(distance_m * 10 as bigint)) % 5")
    some = found.where(n < 2).select(F.col("key_b").alias("a"), F.col("key_a").alias("b"), F.when(n == 0, "never").otherwise("always").alias("verdict"))
    stale = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.concat(F.lit("pge:gone-"), "n_name").alias("a"), F.lit("dhv:gone").alias("b"), F.lit("always").alias("verdict"))
    return some.unionByName(stale)


@query(_with(RECORDS, _PAIRS, _KEYS) + "select p.* from pairs p where not exists (select 1 from dec where verdict = 'never' and least(a, b) = key_a and greatest(a, b) = key_b)")
def apply_never(spark, sf_dir):
    return resolve.apply_never(pairs.candidate_pairs(records(spark, sf_dir)), stated(spark, sf_dir))


@query(_with(RECORDS, _PAIRS, _KEYS) + """select distinct least(a, b) key_a, greatest(a, b) key_b from dec where verdict = 'always' and a in (select "key" from rec) and b in (select "key" from rec)""")
def apply_always(spark, sf_dir):
    return resolve.apply_always(records(spark, sf_dir), stated(spark, sf_dir))


SQL["cluster_with_overrides"] = _recursive(RECORDS, _PAIRS, _KEYS, clusters_sql(True)) + "select * from clus"

_STATUS = """st as (select a, b, verdict, case when a in (select "key" from rec) and b in (select "key" from rec) then 'yes' else 'stale' end status from dec)"""


@query(_with(RECORDS, _PAIRS, _KEYS, _STATUS) + "select * from st")
def override_status(spark, sf_dir):
    return resolve.override_status(stated(spark, sf_dir), records(spark, sf_dir))


@query(_with(RECORDS, _PAIRS, _KEYS, _STATUS) + "select verdict, status, count(*) n from st group by all")
def overrides_report(spark, sf_dir):
    return reports.overrides_report(stated(spark, sf_dir), records(spark, sf_dir))


# --- selection ---------------------------------------------------------------------------

@query(_with(RECORDS, _MEMBERS) + "select cluster_id, cluster_country country, conflict from cc")
def cluster_country(spark, sf_dir):
    return select.cluster_country(members(spark, sf_dir))


@query(_with(RECORDS, _MEMBERS) + """select cluster_id, "key", cluster_country, rnk as rank from ranked""")
def member_rank(spark, sf_dir):
    return select.member_rank(members(spark, sf_dir)).select("cluster_id", "key", "cluster_country", "rank")


@query(_with(RECORDS, _MEMBERS, _CANON) + """select cluster_id, ref, name, lat, lon, role, url, "primary", wind, altitude, notes, closed, tow, site_group, country, source from site""")
def select_canonical(spark, sf_dir):
    s = sites(spark, sf_dir)
    return s.select("cluster_id", "ref", "name", "lat", "lon", "role", "url", "primary", wind_pairs(F.col("wind")).alias("wind"), "altitude", "notes", "closed", "tow", F.array_join("group", ";").alias("site_group"), "country", text.encode_tokens(F.col("sources")).alias("source"))


_IDS = """reg as (select "key", 'SITE-' || printf('%06d', slot + 1) canonical_id, slot + 1 n from rec where k % 97 <> 0 and (slot % 7 <> 3)),
want as (select role || ':' || slot cluster_id, n from rec join reg using ("key") group by all),
low as (select role || ':' || slot cluster_id, min("key") low from rec group by 1),
got as (select n, arg_min(cluster_id, low) cluster_id from want join low using (cluster_id) group by n),
fresh as (select cluster_id, 999990 - 1 + row_number() over (order by low) n from low where cluster_id not in (select cluster_id from got)),
ids as (select cluster_id, 'SITE-' || printf('%06d', n) canonical_id, false is_new from got union all select cluster_id, 'SITE-' || printf('%06d', n), true from fresh)"""


def old_registry(spark, sf_dir):
    kept = derived.base(spark, sf_dir).where("k % 97 <> 0 and slot % 7 <> 3")
    return kept.select(F.col("rkey").alias("key"), F.concat(F.lit("SITE-"), F.format_string("%06d", F.col("slot") + 1)).alias("canonical_id"))


@query(_with(RECORDS, _IDS) + "select * from ids")
def assign_ids(spark, sf_dir):
    return select.assign_ids(derived.slot_clusters(spark, sf_dir), old_registry(spark, sf_dir), 999990)


@query(_with(RECORDS, _IDS) + """select "key", canonical_id from rec join ids on ids.cluster_id = role || ':' || slot""")
def save_registry(spark, sf_dir):
    clusters, old = derived.slot_clusters(spark, sf_dir), old_registry(spark, sf_dir)
    return select.save_registry(clusters, select.assign_ids(clusters, old, 999990), old)


# --- gates and reports -------------------------------------------------------------------

@query(_with(RECORDS) + "select provider, count(*) record_count, count(*) filter (wind <> '') with_wind, round(100.0 * count(*) filter (wind <> '') / count(*), 1) wind_share from rec group by provider")
def source_stats(spark, sf_dir):
    return gates.source_stats(records(spark, sf_dir))


def last_counts(spark, sf_dir):
    """Counts of an earlier run: more suppliers by half, customers and parts as now; a retired guide; no count for one."""
    count = lambda t, name, e: spark.read.parquet(f"{sf_dir}/{t}.parquet").agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), F.expr(e).cast("long").alias("record_count"))
    return count("supplier", "ansg_before", "n + n div 2").union(count("customer", "pge", "n")).union(count("region", "retired", "n"))


_LAST = """last as (select 'ansg_before' source, (select count(*) + count(*) // 2 from supplier) was union all select 'pge', (select count(*) from customer)),
now as (select provider, count(*) n from rec group by 1)"""


@query(_with(RECORDS, _LAST) + """select provider source, (was - n) / was as "drop", coalesce((was - n) / was <= 0.2, true) ok from now left join last on provider = (case source when 'ansg_before' then 'ansg' else source end)""")
def source_health(spark, sf_dir):
    previous = last_counts(spark, sf_dir).withColumn("source", F.when(F.col("source") == "ansg_before", "ansg").otherwise(F.col("source")))
    return gates.source_health(gates.source_stats(records(spark, sf_dir)), previous)


@query(_with(RECORDS) + "select provider source, count(*) record_count, null::varchar version_id from rec group by 1")
def save_run_state(spark, sf_dir):
    return gates.save_run_state(gates.source_stats(records(spark, sf_dir)), last_counts(spark, sf_dir), ["pge", "ansg", "dhv"], {"ansg_before": "ansg"})


def published(spark, sf_dir, earlier: bool):
    """The catalogue as the gates see it; the earlier one lacks some rows, has withdrawn ones and moved places."""
    df = records(spark, sf_dir, ("k",)).select("key", "lat", "lon", "provider", "role", "k")
    ref = F.when(F.lit(earlier) & (F.col("k") % 97 == 0), F.concat("key", F.lit("-old"))).otherwise(F.col("key"))
    lat = F.when(F.lit(earlier) & (F.col("k") % 500 == 1), F.col("lat") + 1).otherwise(F.col("lat"))
    kept = df.where(~(F.lit(earlier) & ((F.col("k") % 31 == 5) | ((F.col("provider") == "ansg") & (F.col("k") % 3 == 0)))))
    return kept.select(ref.alias("ref"), lat.alias("lat"), "lon", F.array("provider").alias("providers"), "role")


_PUB = f"""new as (select "key" ref, lat, lon, provider, role from rec),
old as (select case when k % 97 = 0 then "key" || '-old' else "key" end ref, case when k % 500 = 1 then lat + 1 else lat end lat, lon, provider, role from rec where not (k % 31 = 5 or (provider = 'ansg' and k % 3 = 0))),
diff as (select coalesce(o.ref, n.ref) ref, case when o.ref is null then 'added' when n.ref is null then 'withdrawn' else 'kept' end change, round({_HAV.format(a="o.", b="n.")}, 1) meters from new n full join old o on n.ref = o.ref),
tot as (select (select count(distinct ref) from old) was, (select count(distinct ref) from new) now),
g1 as (select 'count' gate, round(abs((now - was) / was), 6) "value", 0.05 "limit", was || ' -> ' || now detail from tot),
g2 as (select 'provider drop' gate, round((o.n - coalesce(n.n, 0)) / o.n, 6) "value", 0.2 "limit", o.provider detail from (select provider, count(*) n from old group by 1) o left join (select provider, count(*) n from new group by 1) n using (provider)),
g3 as (select 'key churn' gate, round((select count(*) from diff where change = 'withdrawn') / was, 6) "value", 0.02 "limit", (select string_agg(ref, ', ' order by ref) from (select ref from diff where change = 'withdrawn' order by ref limit 3)) detail from tot),
g4 as (select 'key moves' gate, (select count(*) from diff where change = 'kept' and meters > 5000)::double "value", 0.0 "limit", coalesce((select string_agg(ref, ', ' order by meters desc, ref) from (select * from diff where change = 'kept' and meters > 5000 order by meters desc, ref limit 3)), '') detail)"""


def _gate(name: str) -> str:
    return _with(RECORDS, _PUB) + f"""select gate, "value" <= "limit" ok, "value", "limit"::double "limit", detail from {name}"""


@query(_with(RECORDS, _PUB) + "select * from diff")
def catalogue_diff(spark, sf_dir):
    return gates.catalogue_diff(published(spark, sf_dir, False), published(spark, sf_dir, True))


@query(_gate("g1"))
def gate_count(spark, sf_dir):
    return gates.gate_count(published(spark, sf_dir, False), published(spark, sf_dir, True))


@query(_gate("g2"))
def gate_provider_drop(spark, sf_dir):
    return gates.gate_provider_drop(published(spark, sf_dir, False), published(spark, sf_dir, True))


@query(_gate("g3"))
def gate_key_churn(spark, sf_dir):
    return gates.gate_key_churn(gates.catalogue_diff(published(spark, sf_dir, False), published(spark, sf_dir, True)))


@query(_gate("g4"))
def gate_key_moves(spark, sf_dir):
    return gates.gate_key_moves(gates.catalogue_diff(published(spark, sf_dir, False), published(spark, sf_dir, True)))


@query(_gate("(select * from g1 union all select * from g2 union all select * from g3 union all select * from g4)"))
def output_health(spark, sf_dir):
    return gates.output_health(published(spark, sf_dir, False), published(spark, sf_dir, True))


_LABEL = """'**' || {0}.provider || '** [' || replace({0}.name, '|', '\\|') || '](' || {0}.url || ')'"""
_MERGED = f"""duo as (select a.cluster_id, a."key" ka, b."key" kb, a.name na, b.name nb, {_HAV.format(a="a.", b="b.")} m from mem a join mem b on a.cluster_id = b.cluster_id and a."key" < b."key")"""


@query(_with(RECORDS, _MEMBERS, _MERGED, similarity_sql("select ka || ' ' || kb i, na a, nb b from duo"), f"""w as (select cluster_id, max(m) m, arg_max(ka, struct_pack(m := m, a := ka, b := kb)) ka, arg_max(kb, struct_pack(m := m, a := ka, b := kb)) kb, min(similarity) s
  from duo left join sim on sim.i = ka || ' ' || kb group by 1),
names as (select cluster_id, string_agg({_LABEL.format("mem")}, ' · ' order by provider, "key") members from mem group by 1)""") + """
select cluster_id, coalesce(cluster_country, '??') country, members, round(m, 1) spread_m, round(s) similarity, '{"a": "' || ka || '", "b": "' || kb || '", "verdict": "never", "reason": ""}' override
from w join names using (cluster_id) join cc using (cluster_id)""")
def merged_report(spark, sf_dir):
    rows = members(spark, sf_dir)
    return reports.merged_report(records(spark, sf_dir), derived.slot_clusters(spark, sf_dir), select.cluster_country(rows))


@query(_with(RECORDS, _PAIRS, _SIZES, """itm as (select key_a, key_b, distance_m, case when band = 'REVIEW' then 'beyond merge threshold' when ma or mb then 'counterpart already merged' else 'would over-merge the cluster' end reason from j where ca <> cb and not (ma and mb)),
both_ as (select itm.*, a.name na, b.name nb, a.provider pa, b.provider pb, """ + _LABEL.format("a") + " la, " + _LABEL.format("b") + """ lb from itm join rec a on a."key" = key_a join rec b on b."key" = key_b)""",
similarity_sql("select key_a || ' ' || key_b i, na a, nb b from both_")) + """
select case when pa <= pb then la else lb end "first", case when pa <= pb then lb else la end "second", distance_m, round(similarity) similarity, reason,
  '{"a": "' || key_a || '", "b": "' || key_b || '", "verdict": "always", "reason": ""}' override from both_ left join sim on sim.i = key_a || ' ' || key_b""")
def review_report(spark, sf_dir):
    return reports.review_report(review_items(spark, sf_dir), records(spark, sf_dir))


_POINTS = "array_to_string(list_transform(list_filter(string_split({0}, ';'), lambda x: x <> ''), lambda x: string_split(x, ':')[1]), ',')"


@query(_with(RECORDS, _PAIRS, "dup as (select pa provider, key_a, key_b, round(m, 1) distance_m, a.name na, b.name nb, a.wind wa, b.wind wb from near join rec a on a.\"key\" = key_a join rec b on b.\"key\" = key_b where pa = pb and ia < ib and ga <> gb and m <= 250)",
similarity_sql("select key_a || ' ' || key_b i, na a, nb b from dup")) + f"""
select provider, key_a, key_b, distance_m, round(similarity) similarity, {_POINTS.format("wa")} wind_a, {_POINTS.format("wb")} wind_b from dup left join sim on sim.i = key_a || ' ' || key_b""")
def duplicates_report(spark, sf_dir):
    df = records(spark, sf_dir)
    return reports.duplicates_report(pairs.same_source_pairs(df), df)


@query(_with(RECORDS, _PAIRS, _SIZES, _MEMBERS, _CANON, _KEYS, _STATUS, """multi as (select cluster_id from mem group by 1 having count(*) > 1)""", f"""
wide as (select max({_HAV.format(a="a.", b="b.")}) m from mem a join mem b using (cluster_id) where a."key" < b."key" and cluster_id in (from multi))""") + """
select 'sites' metric, '' "label", (select count(*) from site)::double "value"
union all select 'countries', '', (select count(distinct coalesce(country, 'xx')) from site)
union all select 'without wind', '', (select count(*) from site where role = 'launch' and wind = '')
union all select 'merged', '', (select count(*) from multi)
union all select 'widest', '', (select round(m, 1) from wide)
union all select 'review', case when band = 'REVIEW' then 'beyond merge threshold' when ma or mb then 'counterpart already merged' else 'would over-merge the cluster' end, count(*) from j where ca <> cb and not (ma and mb) group by 2
union all select 'duplicates', pa, count(*) from near where pa = pb and ia < ib and ga <> gb and m <= 250 group by 2
union all select 'override warnings', '', (select count(*) from st where status <> 'yes')""")
def run_metrics(spark, sf_dir):
    """All reports of one written table of records and one of pairs."""
    df, clusters = written(records(spark, sf_dir), "records"), derived.slot_clusters(spark, sf_dir)
    found, rows = written(pairs.candidate_pairs(df), "pairs"), select.members(df, clusters)
    merged = reports.merged_report(df, clusters, select.cluster_country(rows))
    out = reports.run_metrics(select.select_canonical(rows), merged, resolve.review_items(found, _halves(spark, sf_dir)), pairs.same_source_pairs(df), resolve.override_status(stated(spark, sf_dir, found), df))
    discard(df)
    discard(found)
    return out


@query(_with(RECORDS, _MEMBERS, _CANON, """f as (select coalesce(country, 'xx') country, wind <> '' windy, dhv is not null has, n_sources = 1 alone from site)""") + """
select country, count(*) filter (not (has and alone)) rows_before, count(*) rows_after,
  case when count(*) filter (not (has and alone)) > 0 then round(100.0 * count(*) filter (windy and not (has and alone)) / count(*) filter (not (has and alone)), 1) end wind_pct_before,
  round(100.0 * count(*) filter (windy) / count(*), 1) wind_pct_after, count(*) filter (has and alone) added, count(*) filter (has and not alone) merged from f group by country""")
def coverage_by_country(spark, sf_dir):
    return reports.coverage_by_country(sites(spark, sf_dir), "dhv")


@query(_with(RECORDS, _MEMBERS, _CANON) + """select ref || '!' as ref, 'ref is not a source' problem from site where low like 'pge:%5' union all select ref, 'no primary' from site where low like 'pge:%7' union all select ref, 'primary is not a source' from site where low like 'pge:%7'""")
def catalogue_checks(spark, sf_dir):
    low = derived.slot_clusters(spark, sf_dir).groupBy("cluster_id").agg(F.min("key").alias("low"))
    broken = sites(spark, sf_dir).join(low, "cluster_id").withColumn("ref", F.when(F.col("low").like("pge:%5"), F.concat("ref", F.lit("!"))).otherwise(F.col("ref")))
    return reports.catalogue_checks(broken.withColumn("primary", F.when(~F.col("low").like("pge:%7"), F.col("primary")).otherwise("")))


# --- sinks and sources -------------------------------------------------------------------

def _numbered(spark, sf_dir):
    """Sites with an id from their first key's order-free number."""
    ids = select.assign_ids(derived.slot_clusters(spark, sf_dir), old_registry(spark, sf_dir), 999990).select("cluster_id", F.col("canonical_id").alias("id"))
    return written(sites(spark, sf_dir).join(ids, "cluster_id"), "sites")  # some queries read them several times


_WINDS = ", ".join(f"coalesce(nullif(regexp_extract(wind, '(^|;){d}:(\\d)', 2), ''), '0') wind_{d.lower()}" for d in DIRECTIONS)
_FLAT = f"""flat as (select substr(canonical_id, 6)::int::varchar id, ref, name, printf('%.6f', lon) longitude, printf('%.6f', lat) latitude, coalesce(altitude::int::varchar, '') altitude,
  lower(coalesce(country, '')) country, {_WINDS}, source, coalesce(closed, '') closed, role site_type, case when tow then '1' else '0' end tow, site_group, "primary" from site join ids using (cluster_id))"""


@query(_with(RECORDS, _MEMBERS, _CANON, _IDS, _FLAT) + "select * from flat")
def write_flat_csv(spark, sf_dir):
    """Written, then read back as text."""
    path = new_path(spark, "flat")
    sinks.write_flat_csv(_numbered(spark, sf_dir), path)
    back = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', schema=", ".join(f"{c} string" for c in sinks.FLAT_COLUMNS))
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in sinks.FLAT_COLUMNS])


@query(_with(RECORDS, _MEMBERS, _CANON, _IDS, _FLAT) + """select ref, latitude::double lat, longitude::double lon, array_to_string(list_sort(list_transform(string_split(source, ';'), lambda x: string_split(x, ':')[1])), ';') providers, site_type role from flat""")
def read_published(spark, sf_dir):
    path = new_path(spark, "flat")
    sinks.write_flat_csv(_numbered(spark, sf_dir), path)
    return readers.read_published(spark, path, DEFAULT.precedence).withColumn("providers", F.array_join("providers", ";"))


@query(_with(RECORDS, _MEMBERS, _CANON) + """select lower(coalesce(country, 'xx')) country, count(*) sites, sum(length(name)) name_chars from site group by 1""")
def write_country_shards(spark, sf_dir):
    """Written, then counted from the shards."""
    path = new_path(spark, "shards")
    sinks.write_country_shards(_numbered(spark, sf_dir), path)
    back = spark.read.schema("value string, country string").text(path)
    return back.groupBy("country").agg(F.count("*").alias("sites"), F.sum(F.length(F.get_json_object("value", "$.name"))).alias("name_chars"))


@query(_with(RECORDS, _MEMBERS, _CANON) + """select lower(coalesce(country, 'xx')) country, case when bool_or(low like 'pge:%33') then 'written' else 'unchanged' end status from site group by 1""")
def shard_changes(spark, sf_dir):
    new = _numbered(spark, sf_dir)
    low = derived.slot_clusters(spark, sf_dir).groupBy("cluster_id").agg(F.min("key").alias("low"))
    old = new.join(low, "cluster_id").withColumn("name", F.when(F.col("low").like("pge:%33"), F.concat("name", F.lit("?"))).otherwise(F.col("name")))
    return sinks.shard_changes(new, old)


# --- scalar functions --------------------------------------------------------------------

@query("with p as (select p_partkey, p_partkey % 16 n from part) select p_partkey, case n " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(derived.PROSE.values())) + " end directions from p")
def parse_conditions(spark, sf_dir):
    prose = F.get(F.array(*map(F.lit, derived.PROSE)), (F.col("p_partkey") % 16).cast("int"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", F.array_join(wind.parse_conditions(prose), ",").alias("directions"))


@query("""select p_partkey, case p_partkey % 4 when 0 then p_size::double when 1 then 1000.0 + p_size when 2 then round((p_size + 1000) * 0.3048, 1) end height from part""")
def parse_height(spark, sf_dir):
    size = F.col("p_size").cast("string")
    said = F.element_at(F.array(F.concat(F.lit("280'/"), size, F.lit("m asl, 250' agl")), F.format_string("2,450ft / %,dm ASL", F.col("p_size") + 1000), F.format_string("%,d ft", F.col("p_size") + 1000), F.lit("unknown")), (F.col("p_partkey") % 4 + 1).cast("int"))
    return spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", text.parse_height(said).alias("height"))


@query("""select c_custkey, (c_custkey * 1.0 + c_custkey + 3.0 + c_custkey + 6.0) / 3 lat, (c_nationkey * 3.0 + 3.0) / 3 lon from customer""")
def ring_centroid(spark, sf_dir):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    ring = F.concat_ws(" ", F.concat_ws(",", n, k), F.concat_ws(",", n + 1, k + 3), F.lit("bad,"), F.concat_ws(",", n + 2, k + 6))
    at = text.ring_centroid(F.array(ring))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", at["lat"].alias("lat"), at["lon"].alias("lon"))


@query("""select doc_id, nullif(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', ''), '') body, regexp_matches(lower(text), 'landing|atterrissage|landeplatz') landing from documents""")
def clean_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    padded = F.concat(F.lit("\t "), "text", F.lit(" \n"))
    return docs.select("doc_id", text.clean_text(padded).alias("body"), (text.infer_role(F.col("text")) == "landing").alias("landing"))


@query("""select c_custkey, case when c_acctbal::varchar not like '-%' then try_cast(c_acctbal::varchar as decimal(38,2))::double end amount, abs(c_custkey)::int n, 'a' || chr(10) || c_name || chr(10) name from customer""")
def text_numbers(spark, sf_dir):
    """unsigned_decimal of the amount as written with two decimals, numeric_id, normalise_newlines"""
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    plain = F.format_string("%.2f", "c_acctbal")
    return df.select("c_custkey", text.unsigned_decimal(plain).alias("amount"), text.numeric_id(F.format_string("SITE-%06d", "c_custkey")).alias("n"), text.normalise_newlines(F.concat(F.lit("a\r\n"), "c_name", F.lit("\r"))).alias("name"))


@query("""select s_suppkey, case s_suppkey % 4 when 0 then 'NNE-SSE' when 1 then 'NE, Ostwind' when 2 then 'ENE-ESE' else 'E' end said, s_suppkey % 3 = 0 approximate from supplier""")
def german_compass(spark, sf_dir):
    """with approximate_flag"""
    n = F.col("s_suppkey")
    said = F.element_at(F.array(*map(F.lit, ("NNO-SSO", "NO, Ostwind", "ONO-OSO", "O"))), (n % 4 + 1).cast("int"))
    place = F.when(n % 3 == 0, "Available to SHC members").otherwise("On the map")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", text.german_compass(said).alias("said"), text.approximate_flag(place).alias("approximate"))


@query(_with(RECORDS) + """select "key", trim(regexp_replace(lower(name), '[^a-z0-9]+', '-', 'g'), '-') slug, role || '' as kind from rec""")
def slugify(spark, sf_dir):
    return records(spark, sf_dir).select("key", text.slugify("name").alias("slug"), F.col("role").alias("kind"))


@query(_with(RECORDS, _MEMBERS, _CANON) + """select ref, source, list_max(list_transform(string_split(source, ';'), lambda x: string_split(x, ':')[1])) last_provider, case when pge is not null then 'https://pge.example.org/?site=' || coalesce(regexp_extract(site_group, '(^|;)pge:([^;]+)', 2), '') end page from site""")
def source_tokens(spark, sf_dir):
    """encode_tokens, decode_tokens, ref_for, source_page_url: a guide's page by its first id in the group."""
    s = sites(spark, sf_dir)
    coded = text.encode_tokens(F.col("sources"))
    decoded = text.decode_tokens(coded)
    mine = F.get(F.filter("group", lambda g: g.startswith("pge:")), F.lit(0))
    page = F.when(F.map_contains_key(decoded, F.lit("pge")), F.replace(F.lit("https://pge.example.org/?site={id}"), F.lit("{id}"), F.substring(mine, F.lit(5), F.length(mine))))
    return s.select(text.ref_for(decoded, DEFAULT.precedence).alias("ref"), coded.alias("source"), F.array_max(F.map_keys(decoded)).alias("last_provider"), page.alias("page"))


@query(_with(RECORDS) + """select "key", '**' || provider || '** [' || replace(name, '|', '\\|') || '](' || url || ')' "label", '{"a": "' || "key" || '", "b": "' || id || '", "verdict": "never", "reason": ""}' entry, lat between -29.5 and -28.5 and lon between 115 and 116 inside from rec""")
def labels(spark, sf_dir):
    """member_label, override_entry, in_bbox"""
    df = records(spark, sf_dir)
    box = geo.bbox_intersect(geo.Box(-40.0, 115.0, -28.5, 116.0), geo.Box(-29.5, 100.0, 0.0, 130.0))
    return df.select("key", text.member_label(F.col("provider"), F.col("name"), F.col("url")).alias("label"), text.override_entry(F.col("key"), F.col("id"), "never").alias("entry"), geo.in_bbox(F.col("lat"), F.col("lon"), box).alias("inside"))


@query("with " + similarity_sql("select p_partkey i, p_name a, p_type b from part") + " select p_partkey, similarity from part left join sim on i = p_partkey")
def name_similarity(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/part.parquet")
    return df.select("p_partkey", text.name_similarity(F.col("p_name"), F.col("p_type")).alias("similarity"))


# --- readers over documents written from the tables ---------------------------------------

def _written_documents(df, path: str, key: str, item, name: str) -> None:
    """JSON documents of up to 1000 items each, in the form the guides publish."""
    grouped = df.withColumn("g", F.floor(F.col(key) / 1000)).groupBy("g").agg(F.collect_list(item).alias(name))
    grouped.select("g", F.to_json(F.struct(name)).alias("value")).write.partitionBy("g").text(path)


@query(_with(RECORDS) + f"""select "key", name, 'launch' as role, lat, lon, wind, altitude, country, 'https://x.example.org/' || id url, k % 7 = 0 tow from rec where provider = 'pge' and {_WORLD.format("lat", "lon")}""")
def read_feature_points(spark, sf_dir):
    df = derived.base(spark, sf_dir).where("provider = 'pge'")
    grades = F.str_to_map(F.coalesce("grades", F.lit("")), F.lit(";"), F.lit(":"))
    text_ = lambda c: F.col(c).cast("string")
    properties = F.struct(
        F.concat(F.lit(" "), "id").alias("pge_site_id"), "name", *[F.coalesce(grades[d], F.lit("0")).alias(d) for d in DIRECTIONS], text_("altitude").alias("takeoff_altitude"),
        F.lower("country").alias("countryCode"), F.concat(F.lit("http://x.example.org/"), "id").alias("pge_link"), F.when(F.col("k") % 7 == 0, "1").otherwise("0").alias("winch"),
    )
    feature = F.struct(F.lit("f").alias("id"), F.struct(F.array("lon", "lat").alias("coordinates")).alias("geometry"), properties.alias("properties"))
    path = new_path(spark, "features")
    _written_documents(df, path, "k", feature, "features")
    back = readers.read_feature_points(spark, path, geo.WORLD)
    return back.select("key", "name", "role", "lat", "lon", wind_pairs(F.col("wind")).alias("wind"), "altitude", "country", "url", "tow")


@query(_with(RECORDS) + """select 'ansg:' || gid || '-' || k as "key", name || ' - Launch ' || k as name, lat, lon, wind, (1000.0 + k % 100)::double altitude, closed, k % 3 = 0 approximate_location, gid group_ids from rec where provider = 'ansg'""")
def read_nested_launches(spark, sf_dir):
    df = derived.base(spark, sf_dir).where("provider = 'ansg'").withColumn("said", F.get(F.array(*map(F.lit, derived.PROSE)), F.col("prose")))
    launch = F.struct(F.col("k").cast("string").alias("id"), F.concat(F.lit("Launch "), F.col("k").cast("string")).alias("name"), "lat", "lon", F.when(F.col("k") % 2 == 0, F.col("said")).alias("conditions"), F.when(F.col("k") % 2 == 0, F.col("closed")).alias("closed"))
    site = F.struct(
        F.col("gid").alias("id"), "name", F.when(F.col("k") % 2 == 1, F.col("said")).alias("conditions"), F.when(F.col("k") % 3 == 0, "Available to club members").alias("shortLocation"),
        F.concat(F.lit("10ft / "), F.format_string("%,d", F.col("k") % 100 + 1000), F.lit("m ASL")).alias("height"), F.when(F.col("k") % 2 == 1, F.col("closed")).alias("closed"), F.array(launch).alias("launches"),
    )
    path = new_path(spark, "export")
    _written_documents(df, path, "k", site, "sites")
    back = readers.read_nested_launches(spark, path, geo.WORLD)
    return back.select("key", "name", "lat", "lon", wind_pairs(F.col("wind")).alias("wind"), "altitude", "closed", "approximate_location", F.array_join("group_ids", ";").alias("group_ids"))
