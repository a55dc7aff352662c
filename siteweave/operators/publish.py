"""Publishing in two phases, and the whole run from guides to a published catalogue.

A root folder holds runs and one small file, CURRENT, which names the run that readers see::

    CURRENT                       the name of the published run
    runs/<run>/verdict            the gates' rows, written also if they refuse
    runs/<run>/shards/country=xx  the shards that this run changed
    runs/<run>/manifest           country, folder, n, sum: where each shard of the catalogue stands
    runs/<run>/flat, ...          the flat CSV and other tables of the run

First the verdict: if a gate fails nothing else is written. Then everything is written into the run's own folder;
unchanged shards are only named again by the manifest. The last step replaces CURRENT at once, so a run that fails or is lost
anywhere leaves the old catalogue as it was, and a reader never sees a mixture.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siteweave.config import DEFAULT, Config
from siteweave.functions.geo import WORLD, Box
from siteweave.functions.text import clean_text
from siteweave.operators import gates, pairs, reports, resolve, select
from siteweave.plans.store import children, discard, remove, small_text, switch, written
from siteweave.sources import readers, sinks

_MANIFEST = "country string, folder string, n bigint, sum decimal(38,0)"
_CANONICAL = "ref string, lat double, lon double, providers array<string>, role string"


def current(spark: SparkSession, root: str) -> str | None:
    """The published run; None before the first."""
    said = small_text(spark, f"{root}/CURRENT")
    return said.strip() if said else None


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """country, folder, n, sum of the published catalogue; no rows before the first run."""
    run = current(spark, root)
    return spark.createDataFrame([], _MANIFEST) if run is None else spark.read.schema(_MANIFEST).parquet(f"{root}/runs/{run}/manifest")


def published_table(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """A Parquet table of the published run; no rows where it has none."""
    run = current(spark, root)
    if run is None or name not in children(spark, f"{root}/runs/{run}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{root}/runs/{run}/{name}")


def published_rows(spark: SparkSession, root: str, config: Config = DEFAULT) -> DataFrame:
    """ref, lat, lon, providers, role of the published flat table, as the gates want them."""
    run = current(spark, root)
    return spark.createDataFrame([], _CANONICAL) if run is None else readers.read_published(spark, f"{root}/runs/{run}/flat", config.precedence)


def read_shards(spark: SparkSession, root: str) -> DataFrame:
    """country, value (the JSON of one site) of the published catalogue, from the folders that the manifest names."""
    folders = [r.folder for r in manifest(spark, root).select("folder").distinct().collect()]  # a row for each country
    if not folders:
        return spark.createDataFrame([], "country string, value string")
    rows = spark.read.schema("value string").text([f"{root}/{f}" for f in folders])
    return rows.select(F.regexp_extract("_metadata.file_path", r"/country=([^/]*)/[^/]*$", 1).alias("country"), "value")


def publish(sites: DataFrame, root: str, config: Config = DEFAULT, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """country, status of each shard. sites are canonical rows with an id; tables are written beside them, with the run.

    Raises ValueError if a gate fails; the verdict then stays in the run's folder and the published catalogue as it was.
    Without any change to a shard nothing is published. If another run was published meanwhile this one isn't (RuntimeError).
    """
    spark = sites.sparkSession
    base, before = current(spark, root), manifest(spark, root)
    run = f"{len(children(spark, f'{root}/runs')) + 1:06d}-{uuid.uuid4().hex[:8]}"
    home = f"{root}/runs/{run}"
    sites = written(sites, "sites")
    now = sites.select("ref", "lat", "lon", F.map_keys("sources").alias("providers"), "role")
    verdict = gates.output_health(now, published_rows(spark, root, config), config)
    verdict.write.parquet(f"{home}/verdict")
    gates.require(verdict)
    rows = written(sinks.shard_rows(sites), "rows")
    sums = rows.groupBy("country").agg(*sinks._sums("body"))
    status = written(sinks._status(sums, before).coalesce(1), "status")  # a row for each country
    if status.where("status <> 'unchanged'").isEmpty():
        return status
    changed = status.where("status = 'written'").select("country")
    sinks._in_files(rows.join(F.broadcast(changed), "country")).write.partitionBy("country").text(f"{home}/shards")
    sinks.write_flat_csv(sites, f"{home}/flat")
    for name, table in (tables or {}).items():
        table.write.parquet(f"{home}/{name}")
    kept = before.join(status.where("status = 'unchanged'"), "country").select("country", "folder", "n", "sum")
    fresh = sums.join(changed, "country").select("country", F.concat(F.lit(f"runs/{run}/shards/country="), "country").alias("folder"), "n", "sum")
    kept.unionByName(fresh).coalesce(1).write.parquet(f"{home}/manifest")
    for table in (rows, sites):
        discard(table)
    if current(spark, root) != base:  # its shards would be lost: they are not in this manifest
        raise RuntimeError("another run was published meanwhile")
    switch(spark, f"{root}/CURRENT", run)
    return status


def expire(spark: SparkSession, root: str) -> list[str]:
    """Removes the runs that the published manifest doesn't need, and says which."""
    run = current(spark, root)
    if run is None:
        return []
    needed = {run, *(r.run for r in manifest(spark, root).select(F.split_part("folder", F.lit("/"), F.lit(2)).alias("run")).distinct().collect())}
    gone = [r for r in children(spark, f"{root}/runs") if r not in needed]
    for r in gone:
        remove(spark, f"{root}/runs/{r}")
    return gone


def run(
    spark: SparkSession,
    root: str,
    sources: dict[str, tuple[Box, Callable[[Box], DataFrame]]],
    guides: DataFrame,
    overrides: DataFrame | None = None,
    scope: Box = WORLD,
    config: Config = DEFAULT,
    renamed: dict[str, str] | None = None,
    versions: DataFrame | None = None,
    dry_run: bool = False,
) -> DataFrame:
    """One run of the whole job; sources: name -> (extent, function of a box giving records).

    Guides are checked before anything is read, sources against the last run's counts before anything is matched, the catalogue
    against the published one before anything is written. Ids, counts and versions are carried from the published
    run and published with the new one. Returns country, status; a dry run returns counts (metric, value) and writes nothing.
    """
    readers.require_guides(list(sources), guides, config)
    records = written(readers.union_records(sources, scope), "records")
    state = published_table(spark, root, "state", "source string, record_count bigint, version_id string")
    counts = gates.source_stats(records)
    named = F.col("source")
    for old, new in (renamed or {}).items():
        named = F.when(named == old, new).otherwise(named)
    health = gates.source_health(counts, state.withColumn("source", named), config)
    bad = health.where("not ok").collect()  # a row for each guide
    if bad:
        raise ValueError("; ".join(f"{r.source} lost {r.drop:.0%} of its records" for r in bad))
    overrides = spark.createDataFrame([], "a string, b string, verdict string, reason string") if overrides is None else readers.checked_overrides(overrides)
    found = written(pairs.candidate_pairs(records, config), "pairs")
    clusters = resolve.cluster_records(records, found, overrides, config)
    review = resolve.review_items(found, clusters, overrides)
    if dry_run:
        sizes = clusters.groupBy("cluster_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("clusters"), F.count_if(F.col("n") > 1).alias("merged"))
        of_guides = counts.select(F.concat(F.lit("records of "), "provider").alias("metric"), F.col("record_count").alias("value"))
        return of_guides.unionByName(sizes.select(F.explode(F.create_map(F.lit("clusters"), F.col("clusters"), F.lit("merged"), F.col("merged"))).alias("metric", "value"))).unionByName(review.agg(F.count("*").alias("value")).select(F.lit("review").alias("metric"), "value"))
    registry = published_table(spark, root, "registry", "key string, canonical_id string")
    last = published_table(spark, root, "numbers", "next_id bigint").agg(F.coalesce(F.max("next_id"), F.lit(1))).first()[0]
    ids = written(select.assign_ids(clusters, registry, last), "ids")
    members = select.members(records, clusters)
    sites = select.select_canonical(members, config).join(ids.select("cluster_id", F.col("canonical_id").alias("id")), "cluster_id")
    tables = {
        "registry": select.save_registry(clusters, ids, registry),
        "numbers": ids.agg((F.count_if("is_new") + last).alias("next_id")),
        "state": gates.save_run_state(counts, state, list(config.precedence), renamed, versions),
        "guides": guides.where(clean_text(F.col("name")).isNotNull()),
        "merged": reports.merged_report(records, clusters, select.cluster_country(members, config)),
        "review": reports.review_report(review, records),
        "duplicates": reports.duplicates_report(pairs.same_source_pairs(records, config), records),
        "overrides": reports.override_entries(overrides, records),
    }
    return publish(sites, root, config, tables)
