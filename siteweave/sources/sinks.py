"""Published forms: per-country JSON, a flat CSV, the guide dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siteweave.config import DIRECTIONS
from siteweave.functions.text import encode_tokens, normalise_newlines, numeric_id
from siteweave.plans.store import discard, exists, remove, written

FLAT_COLUMNS = ["id", "ref", "name", "longitude", "latitude", "altitude", "country", *[f"wind_{d.lower()}" for d in DIRECTIONS], "source", "closed", "site_type", "tow", "site_group", "primary"]


def _grade(d: str):
    return F.coalesce(F.element_at("wind", F.lit(d)), F.lit(0))


def shard_rows(sites: DataFrame) -> DataFrame:
    """country (lower case, xx if none) and body, the JSON of one site in fixed order."""
    wind = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(d).alias("k"), _grade(d).alias("v")) for d in DIRECTIONS]), lambda e: e["v"] > 0))
    sources = F.map_from_entries(F.array_sort(F.map_entries("sources")))
    body = F.struct("id", "name", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), wind.alias("wind"), sources.alias("sources"), "primary", "role", "tow", "group", "altitude", "country", "url", "closed", "notes")
    return sites.select(F.lower(F.coalesce("country", F.lit("xx"))).alias("country"), "id", F.to_json(body).alias("body"))


def _in_files(rows: DataFrame) -> DataFrame:
    """Ranges of (country, id) are written by tasks of their own, so a large country has several files, in order."""
    return rows.repartitionByRange("country", "id").sortWithinPartitions("country", "id").select("country", F.col("body").alias("value"))


def write_country_shards(sites: DataFrame, path: str) -> DataFrame:
    """One folder for each country, rows by id. Only shards whose rows have changed are written again, those of countries
    that are gone are removed; all other files keep their names and times. Returns country, status (a row for each shard).

    Shards are compared by the number and the summed hashes of their rows, before anything is written; the changed ones
    are replaced by a dynamic overwrite of their partitions.
    """
    spark = sites.sparkSession
    rows = written(shard_rows(sites), "rows")
    now = rows.groupBy("country").agg(*_sums("body"))
    stored = spark.read.schema("value string, country string").text(path) if exists(spark, path) else None
    was = now.limit(0) if stored is None else stored.groupBy("country").agg(*_sums("value"))
    status = written(_status(now, was).coalesce(1), "status")
    changed = F.broadcast(status.where("status = 'written'").select("country"))  # a row for each country
    _in_files(rows.join(changed, "country")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("country").text(path)
    if stored is not None:
        folders = stored.select("country", F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")).distinct()
        for row in folders.join(status.where("status = 'removed'"), "country").collect():  # a row for each country
            remove(spark, row.folder)
    discard(rows)
    return status


def _sums(body: str) -> list[Column]:
    return [F.count("*").alias("n"), F.sum(F.xxhash64(body).cast("decimal(38,0)")).alias("sum")]


def _status(new: DataFrame, old: DataFrame) -> DataFrame:
    """country, status of two tables of sums."""
    a, b = new.alias("a"), old.alias("b")
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.sum") == F.col("b.sum"))
    return a.join(b, "country", "full_outer").select("country", F.when(F.col("a.n").isNull(), "removed").when(same, "unchanged").otherwise("written").alias("status"))


def shard_sums(sites: DataFrame) -> DataFrame:
    return shard_rows(sites).groupBy("country").agg(*_sums("body"))


def shard_changes(new: DataFrame, old: DataFrame) -> DataFrame:
    """country, status: written, unchanged or removed."""
    return _status(shard_sums(new), shard_sums(old))


def shard_totals(new: DataFrame, old: DataFrame) -> DataFrame:
    """countries, written, unchanged, sites of the new set, and how many shards are removed: one row."""
    changes = shard_changes(new, old)
    count = lambda status: F.count_if(F.col("status") == status).alias(status)
    totals = changes.agg(F.count_if(F.col("status") != "removed").alias("countries"), count("written"), count("unchanged"), count("removed"))
    return totals.crossJoin(new.agg(F.count("*").alias("sites")))  # one row each


def flat_rows(sites: DataFrame) -> DataFrame:
    """The 21 columns as text."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    return sites.select(
        numeric_id(F.col("id")).cast("string").alias("id"),
        "ref",
        normalise_newlines(F.col("name")).alias("name"),
        F.format_string("%.6f", "lon").alias("longitude"),
        F.format_string("%.6f", "lat").alias("latitude"),
        empty(F.bround("altitude", 0).cast("long").cast("string")).alias("altitude"),
        F.lower(empty(F.col("country"))).alias("country"),
        *[_grade(d).cast("string").alias(f"wind_{d.lower()}") for d in DIRECTIONS],
        encode_tokens(F.col("sources")).alias("source"),
        normalise_newlines(empty(F.col("closed"))).alias("closed"),
        F.col("role").alias("site_type"),
        F.when(F.col("tow"), "1").otherwise("0").alias("tow"),
        F.array_join("group", ";").alias("site_group"),
        "primary",
    )


def write_flat_csv(sites: DataFrame, path: str) -> None:
    rows = flat_rows(sites).orderBy(F.col("id").cast("long"))
    rows.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, lineSep="\n")


def write_guides(guides: DataFrame, path: str) -> None:
    guides.orderBy("name").coalesce(1).write.mode("overwrite").json(path)  # a row for each guide
