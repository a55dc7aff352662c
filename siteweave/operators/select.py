"""From clusters to published rows: country, ranking, gap-filling, stable ids."""

from __future__ import annotations

from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.config import DEFAULT, Config
from siteweave.functions.text import ref_for
from siteweave.operators.components import components
from siteweave.plans.store import discard, merged_in, written


def members(records: DataFrame, clusters: DataFrame) -> DataFrame:
    return records.join(merged_in(clusters), "key")


def cluster_country(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """cluster_id, country, conflict: members' one country, else that of the first scoped guide's member, else the smallest."""
    said = F.nullif("country", F.lit(""))
    scoped = F.when(F.col("provider").isin(*config.scope), said)
    found = rows.groupBy("cluster_id").agg(
        F.count_distinct(said).alias("n"),
        F.min(said).alias("lowest"),
        F.min(F.when(scoped.isNotNull(), F.struct("key", scoped.alias("c"))))["c"].alias("national"),
    )
    return found.select("cluster_id", F.when(F.col("n") <= 1, F.col("lowest")).otherwise(F.coalesce("national", "lowest")).alias("country"), (F.col("n") > 1).alias("conflict"))


def _with_country(rows: DataFrame, config: Config) -> DataFrame:
    """Members with ``cluster_country``, the country of ``cluster_country``: a window over what is brought together by cluster
    anyway, so that members are computed and sent once."""
    said = F.nullif("country", F.lit(""))
    scoped = F.when(F.col("provider").isin(*config.scope), said)
    over = Window.partitionBy("cluster_id")
    lowest, highest = F.min(said).over(over), F.max(said).over(over)
    national = F.min(F.when(scoped.isNotNull(), F.struct("key", scoped.alias("c")))).over(over)["c"]
    return rows.withColumn("cluster_country", F.when(lowest == highest, lowest).otherwise(F.coalesce(national, lowest))).where("cluster_id is not null")


def _standing(config: Config, country: Column) -> Column:
    """(tier, place): guides scoped to the country first, then the fallback, then others."""
    tier, place = F.lit(2), F.lit(0)
    tier = F.when(F.col("provider").isin(*config.fallback), 1).otherwise(tier)
    at: dict[str, list[str]] = {}
    for guide, countries in config.scope.items():
        for c in countries:
            at.setdefault(c, []).append(guide)
    for c, guides in at.items():
        for i, guide in enumerate(guides):
            here = (country == c) & (F.col("provider") == guide)
            tier, place = F.when(here, 0).otherwise(tier), F.when(here, i).otherwise(place)
    return F.struct(tier.alias("tier"), place.alias("place"), F.col("provider"), F.col("key"))


def member_rank(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """Members with the cluster's country and their rank in it (1 wins)."""
    ranked = _with_country(rows, config).withColumn("standing", _standing(config, F.col("cluster_country")))
    return ranked.withColumn("rank", F.row_number().over(Window.partitionBy("cluster_id").orderBy("standing"))).drop("standing")


def select_canonical(rows: DataFrame, config: Config = DEFAULT) -> DataFrame:
    """One row for each cluster: the winner's name, place and link, gaps filled from the others by rank."""
    r = _with_country(rows, config).withColumn("standing", _standing(config, F.col("cluster_country")))
    first = lambda c, usable: F.min_by(c, F.when(usable, F.col("standing")))
    filled = lambda c: F.col(c).isNotNull() & (F.col(c) != "")
    best = lambda c: F.min_by(c, "standing").alias(c)
    tokens = F.transform("group_ids", lambda g: F.concat("provider", F.lit(":"), g))
    done = r.groupBy("cluster_id").agg(
        *[best(c) for c in ("name", "lat", "lon", "role", "url")],
        F.min_by("provider", "standing").alias("primary"),
        first("wind", F.size("wind") > 0).alias("wind"),
        first("altitude", F.col("altitude").isNotNull()).alias("altitude"),
        first("notes", filled("notes")).alias("notes"),
        first("closed", filled("closed")).alias("closed"),
        F.bool_or("tow").alias("tow"),
        F.collect_list(F.struct("standing", "provider", "id")).alias("who"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(tokens)))).alias("group"),
        F.first("cluster_country").alias("country"),
    )
    # of a guide's several members (forced clusters) the last by rank names it
    who = F.array_sort("who")
    last = F.filter(who, lambda x, i: ~F.exists(F.slice(who, i + 2, F.size(who)), lambda y: y["provider"] == x["provider"]))
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<int>"))
    out = done.withColumn("sources", F.map_from_entries(F.transform(last, lambda x: F.struct(x["provider"], x["id"])))).drop("who")
    out = out.withColumn("wind", F.when((F.col("role") == "landing") | F.col("wind").isNull(), none).otherwise(F.col("wind")))
    return out.withColumn("ref", ref_for(F.col("sources"), config.precedence))


def _first_come(batches):
    """Rows (root, low, cluster_id, n) sorted by root, low, n: each cluster takes its first id that no earlier one of its component took."""
    root, taken, cluster, done = None, set(), None, False
    for b in batches:
        out = []
        for r, c, n in zip(b["root"], b["cluster_id"], b["n"]):
            if r != root:
                root, taken, cluster = r, set(), None
            if c != cluster:
                cluster, done = c, False
            if not done and n not in taken:
                taken.add(n)
                done = True
                out.append((c, n))
        yield pd.DataFrame(out, columns=["cluster_id", "n"])


def _by_proposals(wanted: DataFrame, max_rounds: int | None) -> DataFrame:
    """The same by rounds of joins, one for each link of the longest chain: each cluster proposes its lowest untried id,
    an id keeps the earliest proposer, the others go on."""
    gone = written(wanted.select("cluster_id", "n").limit(0), "gone")
    for turn in count(1):
        left = wanted.join(gone, ["cluster_id", "n"], "left_anti")
        asks = written(left.groupBy("cluster_id", "low").agg(F.min("n").alias("n")), "asks")
        holder = asks.groupBy("n").agg(F.min("low").alias("held"))
        refused = written(asks.join(holder, "n").where("low <> held").select("cluster_id", "n"), "refused")
        if refused.isEmpty():
            return asks.select("cluster_id", "n")
        if turn == max_rounds:
            raise RuntimeError(f"ids are contested after {max_rounds} rounds")
        before, gone = gone, written(gone.union(refused), "gone")
        for table in (before, asks, refused):
            discard(table)


def assign_ids(clusters: DataFrame, registry: DataFrame, next_id: int, prefix: str = "SITE-", max_rounds: int | None = None, max_edges: int = 500_000) -> DataFrame:
    """clusters (cluster_id, key), registry (key, canonical_id) -> cluster_id, canonical_id, is_new.

    Clusters in the order of their smallest key take their lowest known id that no earlier one took. Who gets a contested
    id depends only on the clusters that a chain of contested ids links. Those components are decided one after the other
    in tasks, many in each, whatever the length of their chains; a component of more than ``max_edges`` wishes, too large for
    one task, is decided in rounds of joins with equal results. Where ``max_rounds`` is given, all are, and an error is raised
    if that many are not enough.
    """
    ranked = clusters.groupBy("cluster_id").agg(F.min("key").alias("low"))
    number = F.substring_index("canonical_id", "-", -1).cast("long")
    wishes = clusters.join(registry, "key").select("cluster_id", number.alias("n")).distinct().join(ranked, "cluster_id")
    wishes = written(wishes, "wishes")
    contested = wishes.groupBy("n").agg(F.min("low").alias("first"), F.count("*").alias("asked")).where("asked > 1")
    links = written(wishes.join(contested, "n").where("low <> first").select(F.col("low").alias("a"), F.col("first").alias("b")), "links")
    lowest = lambda df: df.groupBy("cluster_id").agg(F.min("n").alias("n"))
    if links.isEmpty():  # no id is wanted twice
        taken = lowest(wishes)
    else:
        roots = components(links).withColumnRenamed("node", "low")
        linked = written(wishes.join(roots, "low"), "linked")
        large = linked.groupBy("root").agg(F.count("*").alias("size")).where(F.col("size") > (max_edges if max_rounds is None else 0))
        tasks = int(clusters.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        small = linked.join(large, "root", "left_anti").repartition(tasks, "root").sortWithinPartitions("root", "low", "n")
        solved = small.mapInPandas(_first_come, f"cluster_id {clusters.schema['cluster_id'].dataType.simpleString()}, n bigint")
        taken = lowest(wishes.join(roots, "low", "left_anti")).unionByName(solved)
        if not large.isEmpty():
            taken = taken.unionByName(_by_proposals(linked.join(large, "root", "left_semi").select("cluster_id", "low", "n"), max_rounds))
    taken = written(taken, "taken")
    discard(links)
    discard(wishes)
    fresh = ranked.join(taken, "cluster_id", "left_anti")
    # numbers without one global window: sort by range, count each part, then number inside the parts
    parts = written(fresh.repartitionByRange("low").withColumn("part", F.spark_partition_id()), "fresh")
    sizes = parts.groupBy("part").agg(F.count("*").alias("size"))
    base = sizes.withColumn("base", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    new = parts.join(base, "part").select("cluster_id", (F.col("base") + next_id - 1 + F.row_number().over(Window.partitionBy("part").orderBy("low"))).alias("n"))
    label = lambda df, is_new: df.select("cluster_id", F.concat(F.lit(prefix), F.format_string("%06d", "n")).alias("canonical_id"), F.lit(is_new).alias("is_new"))
    return label(taken, False).unionByName(label(new, True))


def source_pages(sites: DataFrame, guides: DataFrame) -> DataFrame:
    """sites (ref, group), guides (name, site_url_template) -> ref, provider, page: each guide's page of its first id in the group."""
    token = sites.select("ref", F.posexplode("group").alias("at", "token"))
    first = token.select("ref", "at", F.split_part("token", F.lit(":"), F.lit(1)).alias("provider"), F.regexp_replace("token", "^[^:]*:", "").alias("id"))
    own = first.groupBy("ref", "provider").agg(F.min_by("id", "at").alias("id"))
    template = guides.select(F.col("name").alias("provider"), "site_url_template")
    met = own.join(F.broadcast(template), "provider")  # a row for each guide
    return met.select("ref", "provider", F.replace("site_url_template", F.lit("{id}"), F.col("id")).alias("page"))


def save_registry(clusters: DataFrame, ids: DataFrame, registry: DataFrame) -> DataFrame:
    """key, canonical_id: old keys stay for ever, present ones get their cluster's id."""
    now = clusters.join(ids, "cluster_id").select("key", "canonical_id")
    return registry.join(now, "key", "left_anti").select("key", "canonical_id").unionByName(now)
