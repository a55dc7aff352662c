"""The tables behind the reports, calibration and sweeps over the published rows. Rows come in any order: who shows a
report sorts it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteweave.config import DEFAULT, DIRECTIONS, Config
from siteweave.functions.geo import haversine_m
from siteweave.functions.text import member_label, name_similarity, override_entry
from siteweave.operators.pairs import landing_launches, nearest_counterparts
from siteweave.operators.resolve import override_status
from siteweave.plans.store import merged_in, written

#: Upper ends of the distance bands, the first from 0.
BANDS = (50, 100, 150, 200, 250, 300, 400, 1000)


def _two(pairs: DataFrame, records: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs with both records' columns (suffix _a, _b)."""
    for s in "ab":
        side = records.select(F.col("key").alias(f"key_{s}"), *[F.col(c).alias(f"{c}_{s}") for c in columns if c != "key"])
        pairs = pairs.join(merged_in(side), f"key_{s}")
    return pairs


def _spread(two: DataFrame) -> DataFrame:
    """Pairs dealt evenly over the session's tasks: names cost much time and few bytes, by which partitions would be put together."""
    return two.repartition(int(two.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key_a", "key_b")


def _label(s: str):
    return member_label(F.col(f"provider_{s}"), F.col(f"name_{s}"), F.col(f"url_{s}"))


def merged_report(records: DataFrame, clusters: DataFrame, country: DataFrame) -> DataFrame:
    """cluster_id, country, members, spread_m, similarity, override: clusters of several records.

    Clusters hold a record of each guide at most (forced ones a few more), so pairs in them are few.
    """
    size = clusters.groupBy("cluster_id").agg(F.count("*").alias("n")).where("n > 1")
    rows = records.join(merged_in(clusters.join(merged_in(size), "cluster_id")), "key").select("cluster_id", "key", "provider", "name", "url", "lat", "lon")
    names = rows.groupBy("cluster_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("provider", "key", member_label(F.col("provider"), F.col("name"), F.col("url")).alias("l")))), lambda x: x["l"]), " · ").alias("members"))
    a, b = (rows.select("cluster_id", *[F.col(c).alias(f"{c}_{s}") for c in ("key", "name", "lat", "lon")]) for s in "ab")
    pair = a.join(merged_in(b), "cluster_id").where("key_a < key_b").withColumn("m", haversine_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")))
    pair = pair.withColumn("s", name_similarity("name_a", "name_b"))
    wide = pair.groupBy("cluster_id").agg(F.max(F.struct("m", "key_a", "key_b")).alias("w"), F.min("s").alias("similarity"))
    out = wide.join(merged_in(names), "cluster_id").join(merged_in(country.select("cluster_id", F.coalesce("country", F.lit("??")).alias("country"))), "cluster_id")
    return out.select("cluster_id", "country", "members", F.round("w.m", 1).alias("spread_m"), F.round("similarity", 0).alias("similarity"), override_entry(F.col("w.key_a"), F.col("w.key_b"), "never").alias("override"))


def review_report(items: DataFrame, records: DataFrame) -> DataFrame:
    two = _spread(_two(items, records, ["provider", "name", "url"]))
    swap = F.col("provider_a") <= F.col("provider_b")
    return two.select(
        F.when(swap, _label("a")).otherwise(_label("b")).alias("first"),
        F.when(swap, _label("b")).otherwise(_label("a")).alias("second"),
        "distance_m",
        F.round(name_similarity("name_a", "name_b"), 0).alias("similarity"),
        "reason",
        override_entry(F.col("key_a"), F.col("key_b"), "always").alias("override"),
    )


def wind_text(wind):
    return F.array_join(F.filter(F.array(*map(F.lit, DIRECTIONS)), lambda d: F.coalesce(F.element_at(wind, d), F.lit(0)) > 0), ",")


def duplicates_report(pairs: DataFrame, records: DataFrame) -> DataFrame:
    two = _spread(_two(pairs, records.drop("provider"), ["name", "wind"]))
    return two.select("provider", "key_a", "key_b", "distance_m", F.round(name_similarity("name_a", "name_b"), 0).alias("similarity"), wind_text(F.col("wind_a")).alias("wind_a"), wind_text(F.col("wind_b")).alias("wind_b"))


def overrides_report(overrides: DataFrame, records: DataFrame) -> DataFrame:
    """verdict, status, n."""
    return override_status(overrides, records).groupBy("verdict", "status").agg(F.count("*").alias("n"))


def override_entries(overrides: DataFrame, records: DataFrame) -> DataFrame:
    """verdict, nth (by a, then b within its verdict), first, second, reason, status: each entry with its records' names.

    A key without a record is shown as it is, so that a stale entry can be seen; the keys of a pair stand in their order.
    """
    given = overrides if "reason" in overrides.columns else overrides.withColumn("reason", F.lit(None).cast("string"))
    both = given.join(override_status(overrides, records).distinct(), ["a", "b", "verdict"])
    label = records.select("key", member_label(F.col("provider"), F.col("name"), F.col("url")).alias("label"))
    low, high = F.least("a", "b"), F.greatest("a", "b")
    named = both.join(label.select(F.col("key").alias("low"), F.col("label").alias("l")), low == F.col("low"), "left").join(label.select(F.col("key").alias("high"), F.col("label").alias("h")), high == F.col("high"), "left")
    cell = lambda shown, key: F.coalesce(shown, F.when(F.coalesce(key, F.lit("")) != "", F.concat(F.lit("`"), key, F.lit("`"))), F.lit("—"))
    nth = F.row_number().over(Window.partitionBy("verdict").orderBy("a", "b"))
    reason = F.replace(F.coalesce("reason", F.lit("—")), F.lit("|"), F.lit("\\|"))
    return named.select("verdict", nth.alias("nth"), cell(F.col("l"), low).alias("first"), cell(F.col("h"), high).alias("second"), reason.alias("reason"), "status")


def duplicate_counts(pairs: DataFrame) -> DataFrame:
    """provider, n: how many pairs each guide has."""
    return pairs.groupBy("provider").agg(F.count("*").alias("n"))


def run_metrics(canonical: DataFrame, merged: DataFrame, review: DataFrame, duplicates: DataFrame, status: DataFrame) -> DataFrame:
    """metric, label, value: one small aggregate after the other, each of one pass over its table and written before the next is
    planned, so that the driver never holds the plans and the broadcasts of all of them."""

    def several(df, **values):
        row = df.agg(*[v.cast("double").alias(n) for n, v in values.items()])
        return row.select(F.inline(F.array(*[F.struct(F.lit(n.replace("_", " ")).alias("metric"), F.lit("").alias("label"), F.col(n).alias("value")) for n in values])))

    by = lambda df, metric, label: df.groupBy(F.col(label).alias("label")).agg(F.count("*").cast("double").alias("value")).select(F.lit(metric).alias("metric"), "label", "value")
    parts = (
        several(canonical, sites=F.count("*"), countries=F.count_distinct(F.coalesce("country", F.lit("xx"))), without_wind=F.count_if((F.col("role") == "launch") & (F.size("wind") == 0))),
        several(merged, merged=F.count("*"), widest=F.max("spread_m")),
        by(review, "review", "reason"),
        by(duplicates, "duplicates", "provider"),
        several(status, override_warnings=F.count_if(F.col("status") != "yes")),
    )
    return reduce(DataFrame.unionByName, [written(p.coalesce(1), "metrics") for p in parts])  # some rows each


def calibration_histogram(records: DataFrame, source: str, countries: list[str], config: Config = DEFAULT) -> DataFrame:
    """band (its upper end; null beyond the last), n, and ambiguous: second candidates inside the merge distance."""
    near = nearest_counterparts(records, source, countries, float(BANDS[-1]))
    band = F.lit(None).cast("int")
    for high in reversed(BANDS):
        band = F.when(F.col("meters") < high, high).otherwise(band)
    first = near.where("rank = 1 or rank is null").groupBy(band.alias("band")).agg(F.count("*").alias("n"))
    second = near.where(F.col("rank") == 2).select(F.when(F.col("meters") < config.merge_m, 1).alias("x")).agg(F.count("x").alias("ambiguous"))
    every = records.sparkSession.createDataFrame([(h,) for h in (*BANDS, None)], "band int")
    joined = every.join(first.withColumnRenamed("band", "b"), F.col("band").eqNullSafe(F.col("b")), "left")
    return joined.crossJoin(second).select("band", F.coalesce("n", F.lit(0)).alias("n"), "ambiguous")


def calibration_samples(records: DataFrame, source: str, countries: list[str], config: Config = DEFAULT, k: int = 12) -> DataFrame:
    """side, key, other, distance_m: the nearest k pairs just inside and just outside the merge distance (a report of top k)."""
    near = nearest_counterparts(records, source, countries, config.review_m).where("rank = 1")
    inside = (F.col("meters") >= 0.6 * config.merge_m) & (F.col("meters") < config.merge_m)
    outside = (F.col("meters") >= config.merge_m) & (F.col("meters") < config.review_m)
    side = near.withColumn("side", F.when(inside, "inside").when(outside, "outside")).where("side is not null")
    top = side.withColumn("n", F.row_number().over(Window.partitionBy("side").orderBy("meters", "key"))).where(F.col("n") <= k)
    return top.select("side", "key", "other", F.round("meters", 1).alias("distance_m"))


def landing_gaps(records: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """provider, landings, median_m, p90_m, within: how far landings lie from the nearest of their own launches."""
    tokens = records.select("key", "role", F.transform("group_ids", lambda g: F.concat("provider", F.lit(":"), g)).alias("tokens"))
    two = _two(landing_launches(tokens).select(F.col("landing").alias("key_a"), F.col("launch").alias("key_b")), records, ["provider", "lat", "lon"])
    meters = F.round(haversine_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")), 1)
    near = two.groupBy("key_a", F.col("provider_a").alias("provider")).agg(F.min(meters).alias("m"))
    return near.groupBy("provider").agg(
        F.count("*").alias("landings"),
        F.percentile_approx("m", 0.5, 10_000).alias("median_m"),
        F.percentile_approx("m", 0.9, 10_000).alias("p90_m"),
        F.count_if(F.col("m") <= config.merge_m).alias("within"),
    )


def coverage_by_country(canonical: DataFrame, guide: str) -> DataFrame:
    """country, rows and wind percent without and with a guide, rows it added, rows it shares."""
    has, alone = F.map_contains_key("sources", F.lit(guide)), F.size("sources") == 1
    windy = F.size("wind") > 0
    out = canonical.groupBy(F.coalesce("country", F.lit("xx")).alias("country")).agg(
        F.count_if(~(has & alone)).alias("rows_before"),
        F.count("*").alias("rows_after"),
        F.count_if(windy & ~(has & alone)).alias("wind_before"),
        F.count_if(windy).alias("wind_after"),
        F.count_if(has & alone).alias("added"),
        F.count_if(has & ~alone).alias("merged"),
    )
    share = lambda a, b: F.when(F.col(b) > 0, F.round(100.0 * F.col(a) / F.col(b), 1))
    return out.select("country", "rows_before", "rows_after", share("wind_before", "rows_before").alias("wind_pct_before"), share("wind_after", "rows_after").alias("wind_pct_after"), "added", "merged")


def catalogue_checks(canonical: DataFrame) -> DataFrame:
    """ref, problem: rows whose keys contradict one another."""
    tokens = F.transform(F.map_entries("sources"), lambda e: F.concat(e["key"], F.lit(":"), e["value"]))
    groups = F.transform("group", lambda g: F.split_part(g, F.lit(":"), F.lit(1)))
    problems = F.array(
        F.when(F.coalesce("primary", F.lit("")) == "", "no primary"),
        F.when(~F.map_contains_key("sources", F.col("primary")), "primary is not a source"),
        F.when(F.size(F.array_except(F.map_keys("sources"), groups)) > 0, "source without a group"),
        F.when(~F.array_contains(tokens, F.col("ref")), "ref is not a source"),
    )
    return canonical.select("ref", F.explode(F.array_compact(problems)).alias("problem"))
