"""Range joins by distance over an equi-join on grid cells.

Latitude bands are a little wider than the radius. Each band is cut into as many cells as
fit at its end nearer to a pole, so neighbours are always the next cells, at any latitude and
across the date line. One side is sent to its 9 neighbour cells, the other stays in its own.

Cells are counted first. One with more than ``CROWD`` rows is cut again, into m x m smaller ones that
hold about that many each; the other side is then sent to those that its surroundings reach, a
little over two cells' width each way instead of three. Points that share a place can't be told apart by any grid: they
stay one join key, which adaptive execution splits. What else must be equal for a pair (role,
guide) is part of the key, so rows that can't be a pair don't meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.config import DEFAULT, Config
from siteweave.functions.geo import EARTH_M, haversine_m
from siteweave.plans.store import merged_in

#: Cells are this much wider than the radius.
SLACK = 1.02
#: Rows of a cell that isn't cut again; cells that are, at most (24 bytes each are sent to every task), and their cuts each way.
CROWD, CROWDED, CUTS = 5_000, 100_000, 64


def _cells_in(band: Column, step: float) -> Column:
    far = F.least(F.greatest(F.abs(band * step), F.abs((band + 1) * step)), F.lit(90.0))
    return F.greatest(F.floor(360.0 * F.cos(F.radians(far)) / step), F.lit(1)).cast("long")


def _across(lon: Column, band: Column, step: float) -> Column:
    """Cells from the date line eastwards; the whole part is the cell."""
    return (lon + 180.0) / 360.0 * _cells_in(band, step)


def _cell(lon: Column, band: Column, step: float) -> Column:
    return F.pmod(F.floor(_across(lon, band, step)).cast("long"), _cells_in(band, step))


def _step(radius_m: float) -> float:
    return math.degrees(radius_m / EARTH_M) * SLACK


def crowded_cells(rows: DataFrame, radius_m: float, crowd: int = CROWD) -> DataFrame:
    """band, cell, n, cuts: cells of rows (lat, lon) with more than ``crowd`` rows, and how often they are cut each way."""
    step = _step(radius_m)
    at = rows.select(F.floor(F.col("lat") / step).cast("long").alias("band"), "lon").where("band is not null and lon is not null")
    cells = at.groupBy("band", _cell(F.col("lon"), F.col("band"), step).alias("cell")).agg(F.count("*").alias("n"))
    return cells.where(F.col("n") > crowd).withColumn("cuts", F.least(F.ceil(F.sqrt(F.col("n") / crowd)), F.lit(CUTS)).cast("int"))


def near(left: DataFrame, right: DataFrame, radius_m: float, equal: tuple[tuple[str, str], ...] = (), crowd: int = CROWD) -> DataFrame:
    """left (with lat, lon) x right (with lat2, lon2) within the radius, with ``meters`` (not rounded); equal: columns that must
    agree, of left and right.

    Rows without coordinates meet nothing. Cells are counted at once, the join itself is lazy.
    """
    step = _step(radius_m)
    band = lambda lat: F.floor(lat / step).cast("long")
    at = left.withColumn("__band", band(F.col("lat"))).withColumn("__cell", _cell(F.col("lon"), F.col("__band"), step))
    bands = right.withColumn("__b", F.explode(F.array(*[band(F.col("lat2")) + i for i in (-1, 0, 1)])))
    n, mid = _cells_in(F.col("__b"), step), _cell(F.col("lon2"), F.col("__b"), step)
    same = [(F.col(a) == F.col(b)) for a, b in equal]
    crowded = crowded_cells(left, radius_m, crowd).limit(CROWDED + 1).collect()  # 24 bytes each
    if not crowded or len(crowded) > CROWDED:
        around = bands.withColumn("__c", F.explode(F.array_distinct(F.array(*[F.pmod(mid + i, n) for i in (-1, 0, 1)]))))
        key = (F.col("__band") == F.col("__b")) & (F.col("__cell") == F.col("__c"))
    else:
        cuts = F.broadcast(left.sparkSession.createDataFrame([(r.band, r.cell, r.cuts) for r in crowded], "__hb long, __hc long, __cuts int"))  # CROWDED rows
        # where a row stands in its cell, from 0 to 1 each way
        up, along = F.col("lat") / step - F.col("__band"), F.pmod(_across(F.col("lon"), F.col("__band"), step), F.lit(1.0))
        m = F.coalesce("__cuts", F.lit(1))
        part = lambda x: F.least(F.floor(x * m), m - 1).cast("int")
        at = at.join(cuts, (F.col("__band") == F.col("__hb")) & (F.col("__cell") == F.col("__hc")), "left")
        at = at.withColumn("__part", part(up) * m + part(along)).drop("__hb", "__hc", "__cuts")
        # where the other side's rows stand from those cells, and the parts within a cell's width of them; around a pole all
        beside = F.array(*[F.struct(F.pmod(mid + i, n).alias("c"), F.when(n >= 3, F.pmod(_across(F.col("lon2"), F.col("__b"), step), F.lit(1.0)) - i).alias("x")) for i in (-1, 0, 1)])
        alone = F.filter(beside, lambda s, i: (n >= 3) | ~F.exists(F.slice(beside, 1, i), lambda y: y["c"] == s["c"]))
        around = bands.withColumn("__s", F.explode(alone)).withColumn("__c", F.col("__s.c"))
        around = around.join(cuts, (F.col("__b") == F.col("__hb")) & (F.col("__c") == F.col("__hc")), "left")
        reach = lambda x: F.sequence(F.greatest(F.floor((x - 1) * m), F.lit(0)).cast("int"), F.least(F.floor((x + 1) * m), m - 1).cast("int"))
        rows_, columns_ = reach(F.col("lat2") / step - F.col("__b")), F.coalesce(reach(F.col("__s.x")), F.sequence(F.lit(0), m - 1))
        parts = F.flatten(F.transform(rows_, lambda i: F.transform(columns_, lambda j: i * m + j)))
        around = around.withColumn("__p", F.explode(parts)).drop("__s", "__hb", "__hc", "__cuts")
        key = (F.col("__band") == F.col("__b")) & (F.col("__cell") == F.col("__c")) & (F.col("__part") == F.col("__p"))
    for e in same:
        key = key & e
    met = at.join(merged_in(around), key)
    close = met.where(F.abs(F.col("lat") - F.col("lat2")) <= step)
    found = close.withColumn("meters", haversine_m(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")))
    return found.where(F.col("meters") <= radius_m).drop("__band", "__cell", "__part", "__b", "__c", "__p")


def _sides(records: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    left = records.select("lat", "lon", *[F.col(c).alias(f"{c}_a") for c in columns])
    right = records.select(F.col("lat").alias("lat2"), F.col("lon").alias("lon2"), *[F.col(c).alias(f"{c}_b") for c in columns])
    return left, right


def candidate_pairs(records: DataFrame, config: Config = DEFAULT, crowd: int = CROWD) -> DataFrame:
    """key_a < key_b, distance_m (0.1), band MERGE or REVIEW: records of different guides and one role.

    A record stands in its cell once for each guide whose name follows its own, and meets only that guide's records.
    """
    left, right = _sides(records, ["key", "provider", "role", "approximate_location"])
    guides = records.agg(F.collect_set("provider").alias("__guides"))  # one row
    left = left.crossJoin(F.broadcast(guides)).withColumn("__other", F.explode(F.filter("__guides", lambda g: g > F.col("provider_a")))).drop("__guides")
    pairs = near(left, right, config.review_m, (("role_a", "role_b"), ("__other", "provider_b")), crowd)
    merge = (F.col("meters") <= config.merge_m) & ~F.col("approximate_location_a") & ~F.col("approximate_location_b")
    return pairs.select(F.least("key_a", "key_b").alias("key_a"), F.greatest("key_a", "key_b").alias("key_b"), F.round("meters", 1).alias("distance_m"), F.when(merge, "MERGE").otherwise("REVIEW").alias("band"))


def same_source_pairs(records: DataFrame, config: Config = DEFAULT, crowd: int = CROWD) -> DataFrame:
    """provider, key_a, key_b (by id), distance_m: records of one guide and role that share no group."""
    met = near(*_sides(records, ["key", "id", "provider", "role", "group_ids"]), config.merge_m, (("provider_a", "provider_b"), ("role_a", "role_b")), crowd)
    pairs = met.where("id_a < id_b and not arrays_overlap(group_ids_a, group_ids_b)")
    return pairs.select(F.col("provider_a").alias("provider"), "key_a", "key_b", F.round("meters", 1).alias("distance_m"))


def landing_launches(sites: DataFrame) -> DataFrame:
    """sites (key, role, tokens) -> landing, launch: pairs that share a provider:group token."""
    token = sites.select("key", "role", F.explode("tokens").alias("token")).distinct()
    landing = token.where("role = 'landing'").select(F.col("key").alias("landing"), "token")
    launch = token.where("role = 'launch'").select(F.col("key").alias("launch"), "token")
    return landing.join(merged_in(launch), "token").select("landing", "launch").distinct()


def nearest_counterparts(records: DataFrame, source: str, countries: list[str], within_m: float = 1000.0, k: int = 2) -> DataFrame:
    """key, rank, other, meters: the k nearest launches of other guides for each launch of one; rank null if none is within reach."""
    launches = records.where((F.col("role") == "launch") & F.upper("country").isin([c.upper() for c in countries]))
    mine = launches.where(F.col("provider") == source).select("key", "lat", "lon")
    others = launches.where(F.col("provider") != source).select(F.col("key").alias("other"), F.col("lat").alias("lat2"), F.col("lon").alias("lon2"))
    order = Window.partitionBy("key").orderBy("meters", "other")
    ranked = near(mine, others, within_m).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return mine.select("key").join(merged_in(ranked.select("key", "rank", "other", "meters")), "key", "left")
