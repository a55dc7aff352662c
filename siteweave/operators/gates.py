"""Checks before publishing: sources against the last run, the new catalogue against the old.

new: ref, lat, lon, providers array<string>, role; old: the same. One row for each gate.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.config import DEFAULT, Config
from siteweave.functions.geo import haversine_m
from siteweave.plans.store import discard, written


def source_stats(records: DataFrame) -> DataFrame:
    """provider, record_count, with_wind, wind_share (percent)."""
    out = records.groupBy("provider").agg(F.count("*").alias("record_count"), F.count_if(F.size("wind") > 0).alias("with_wind"))
    return out.withColumn("wind_share", F.round(100.0 * F.col("with_wind") / F.col("record_count"), 1))


def source_health(stats: DataFrame, previous: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """source, drop, ok: a guide that lost too much; one without an earlier count isn't judged."""
    was = previous.select(F.col("source").alias("provider"), F.col("record_count").alias("was"))
    drop = F.when(F.col("was") > 0, (F.col("was") - F.col("record_count")) / F.col("was"))
    return stats.join(was, "provider", "left").select(F.col("provider").alias("source"), drop.alias("drop"), F.coalesce(drop <= config.max_source_drop, F.lit(True)).alias("ok"))


def one_per_ref(rows: DataFrame) -> DataFrame:
    """One row for each ref; of several the one with the largest coordinates, so that the choice is fixed."""
    return rows.groupBy("ref").agg(F.max(F.struct("lat", "lon", "role")).alias("r")).select("ref", "r.lat", "r.lon", "r.role")


def catalogue_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """ref, change (added, withdrawn, kept), meters moved."""
    now = one_per_ref(new).select("ref", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"), F.lit(1).alias("now"))
    was = one_per_ref(old).select("ref", F.col("lat").alias("lat0"), F.col("lon").alias("lon0"), F.lit(1).alias("was"))
    both = now.join(was, "ref", "full_outer")
    change = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "withdrawn").otherwise("kept")
    return both.select("ref", change.alias("change"), F.round(haversine_m(F.col("lat0"), F.col("lon0"), F.col("lat1"), F.col("lon1")), 1).alias("meters"))


def _row(gate: str, ok: Column, value: Column, limit: float, detail: Column) -> list[Column]:
    return [F.lit(gate).alias("gate"), ok.alias("ok"), value.cast("double").alias("value"), F.lit(float(limit)).alias("limit"), detail.alias("detail")]


def gate_count(new: DataFrame, old: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Change of the number of refs, after what guides or roles never published before explain (growth only)."""
    sets = old.agg(F.count_distinct("ref").alias("was"), F.array_distinct(F.flatten(F.collect_set("providers"))).alias("known"), F.collect_set("role").alias("roles"))
    now = new.agg(F.count_distinct("ref").alias("now"))
    fresh = new.crossJoin(F.broadcast(sets)).where((F.size(F.array_except("providers", "known")) == F.size(F.array_distinct("providers"))) | ~F.array_contains("roles", F.col("role")))
    joined = sets.crossJoin(now).crossJoin(fresh.agg(F.count("*").alias("accounted")))  # one row each
    delta = (F.col("now") - F.col("was")) / F.col("was")
    allowance = F.when(delta > 0, F.col("accounted") / F.col("was")).otherwise(0.0)
    value = F.round(F.abs(delta - allowance), 6)
    return joined.where("was > 0").select(*_row("count", value <= config.max_count_delta, value, config.max_count_delta, F.concat_ws(" -> ", "was", "now")))


def gate_provider_drop(new: DataFrame, old: DataFrame, config: Config = DEFAULT) -> DataFrame:
    count = lambda df, n: df.select(F.explode(F.array_distinct("providers")).alias("p")).groupBy("p").agg(F.count("*").alias(n))
    both = count(old, "was").join(count(new, "now"), "p", "left")
    value = F.round((F.col("was") - F.coalesce("now", F.lit(0))) / F.col("was"), 6)
    return both.select(*_row("provider drop", value <= config.max_provider_drop, value, config.max_provider_drop, F.col("p")))


def gate_key_churn(diff: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Share of old refs withdrawn; the first three as an example."""
    gone = diff.where("change = 'withdrawn'")
    example = gone.orderBy("ref").limit(3).agg(F.array_join(F.array_sort(F.collect_list("ref")), ", ").alias("detail"))
    sums = diff.agg(F.count_if(F.col("change") == "withdrawn").alias("gone"), F.count_if(F.col("change") != "added").alias("was"))
    value = F.round(F.col("gone") / F.col("was"), 6)
    return sums.crossJoin(example).where("was > 0").select(*_row("key churn", value <= config.max_key_churn, value, config.max_key_churn, F.col("detail")))


def gate_key_moves(diff: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """How many kept refs moved too far; the three worst."""
    far = diff.where((F.col("change") == "kept") & (F.col("meters") > config.max_key_move_m))
    worst = far.orderBy(F.desc("meters"), "ref").limit(3).agg(F.array_sort(F.collect_list(F.struct((-F.col("meters")).alias("m"), "ref"))).alias("w"))
    counted = far.agg(F.count("*").alias("n")).crossJoin(worst)
    return counted.select(*_row("key moves", F.col("n") == 0, F.col("n"), 0, F.array_join(F.transform("w", lambda x: x["ref"]), ", ")))


def output_health(new: DataFrame, old: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """All gates; with nothing published yet, one row that says so. Both catalogues are read once: the gates read the few
    columns that they need from written tables, the rows of the result are a written table too."""
    columns = ["ref", "lat", "lon", "providers", "role"]
    new, old = written(new.select(columns), "new"), written(old.select(columns), "old")
    diff = written(catalogue_diff(new, old), "diff")
    gates = reduce(DataFrame.unionByName, [gate_count(new, old, config), gate_provider_drop(new, old, config), gate_key_churn(diff, config), gate_key_moves(diff, config).join(old.limit(1).select(F.lit(1).alias("any")), F.lit(True)).drop("any")])
    none = old.agg(F.count("*").alias("n")).where("n = 0").select(*_row("first run", F.lit(True), F.lit(0), 0, F.lit("nothing published yet")))
    out = written(gates.unionByName(none).coalesce(1), "gates")  # some rows
    for table in (new, old, diff):
        discard(table)
    return out


def require(health: DataFrame) -> None:
    """Raises if a gate failed (a few rows)."""
    bad = health.where("not ok").collect()
    if bad:
        raise ValueError("; ".join(f"{r.gate}: {r.value:g} beyond {r.limit:g} ({r.detail})" for r in bad))


def save_run_state(stats: DataFrame, state: DataFrame, known: list[str], renamed: dict[str, str] | None = None, versions: DataFrame | None = None) -> DataFrame:
    """source, record_count, version_id: this run's counts and versions (source, version_id), else the carried ones; retired guides go."""
    name = F.col("source")
    for old, new in (renamed or {}).items():
        name = F.when(F.col("source") == old, new).otherwise(name)
    version = F.col("version_id") if "version_id" in state.columns else F.lit(None).cast("string")
    was = state.select(name.alias("source"), F.col("record_count").alias("was"), version.alias("had")).groupBy("source").agg(F.max("was").alias("was"), F.max("had").alias("had"))
    now = stats.select(F.col("provider").alias("source"), F.col("record_count").alias("now"))
    both = was.join(now, "source", "full_outer")
    both = both.withColumn("has", F.lit(None).cast("string")) if versions is None else both.join(versions.select("source", F.col("version_id").alias("has")), "source", "full_outer")
    return both.where(F.col("source").isin(known)).select("source", F.coalesce("now", "was").alias("record_count"), F.coalesce("has", "had").alias("version_id"))
