"""Entity resolution: overrides, guarded clustering, review items.

Merge pairs are taken by ascending (rounded) distance, ties by keys. Two clusters join only if
every pair across them lies within the merge distance or is forced. Decisions depend on one
connected component only: pairs whose ends have no other pair are clusters at once, components of
the other pairs are decided in tasks, many in each, and components of more than ``max_edges`` pairs in
rounds of joins with equal results. The clusters are a written table.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteweave.config import DEFAULT, Config
from siteweave.operators.components import components
from siteweave.plans.store import discard, merged_in, written


def override_pairs(overrides: DataFrame, verdict: str) -> DataFrame:
    return overrides.where(F.col("verdict") == verdict).select(F.least("a", "b").alias("key_a"), F.greatest("a", "b").alias("key_b")).distinct()


def apply_never(pairs: DataFrame, overrides: DataFrame) -> DataFrame:
    """Pairs without the rejected ones."""
    return pairs.join(merged_in(override_pairs(overrides, "never")), ["key_a", "key_b"], "left_anti")


def apply_always(records: DataFrame, overrides: DataFrame) -> DataFrame:
    """Forced pairs whose keys both exist."""
    keys = merged_in(records.select("key"))
    forced = override_pairs(overrides, "always")
    return forced.join(keys.withColumnRenamed("key", "key_a"), "key_a", "left_semi").join(keys.withColumnRenamed("key", "key_b"), "key_b", "left_semi").select("key_a", "key_b")


def _greedy(rows: list[tuple], merge_m: float) -> list[tuple[str, str]]:
    """One component: rows (key_a, key_b, distance_m, band, forced) -> (key, cluster_id)."""
    cluster: dict[str, str] = {}
    members: dict[str, list[str]] = {}
    allowed: set[tuple[str, str]] = set()
    for a, b, meters, _, forced in rows:
        for k in (a, b):
            cluster[k], members[k] = k, [k]
        if forced or meters <= merge_m:
            allowed |= {(a, b), (b, a)}

    def join(x, y):
        low, high = min(x, y), max(x, y)
        for k in members[high]:
            cluster[k] = low
        members[low] += members.pop(high)

    for a, b, *_ in (r for r in rows if r[4]):
        if cluster[a] != cluster[b]:
            join(cluster[a], cluster[b])
    for _, a, b in sorted((r[2], r[0], r[1]) for r in rows if r[3] == "MERGE"):
        x, y = cluster[a], cluster[b]
        if x != y and all((p, q) in allowed for p in members[x] for q in members[y]):
            join(x, y)
    return list(cluster.items())


def _components_at_once(inside: DataFrame, merge_m: float) -> DataFrame:
    """inside (root, pair columns) -> (key, cluster_id): many components for each task and batch."""

    def run(batches):
        rest = None
        for b in batches:
            if rest is not None:
                b = pd.concat([rest, b])
            last = b["root"].iloc[-1] if len(b) else None
            rest, done = b[b["root"] == last], b[b["root"] != last]
            yield decided(done)
        if rest is not None and len(rest):
            yield decided(rest)

    def decided(rows):
        out, names = [], ["key_a", "key_b", "distance_m", "band", "forced"]
        roots = rows["root"].to_numpy()
        cut = [0, *(i for i in range(1, len(roots)) if roots[i] != roots[i - 1]), len(roots)]
        flat = list(rows[names].itertuples(index=False, name=None))
        for a, b in zip(cut, cut[1:]):
            out += _greedy(flat[a:b], merge_m)
        return pd.DataFrame(out, columns=["key", "cluster_id"])

    tasks = int(inside.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return inside.repartition(tasks, "root").sortWithinPartitions("root").mapInPandas(run, "key string, cluster_id string")


def _in_rounds(pairs: DataFrame, merge_m: float, max_rounds: int = 1000) -> DataFrame:
    """The same by joins over a graph of clusters, contracted in each round.

    An edge of two clusters has the number of pairs across that are allowed and the first merge pair among them. It is complete
    if all pairs across are allowed; one that isn't never becomes so, as clusters only grow, and is left out at once. A merge is
    decided when its edge has the first merge pair of both its clusters: earlier pairs touch neither. All such merges
    of a round happen together, then their clusters and edges are joined, so a round's work shrinks with what is decided.
    """
    order = F.struct("distance_m", "key_a", "key_b")
    one = pairs.groupBy("key_a", "key_b").agg(F.min(F.when(F.col("band") == "MERGE", order)).alias("turn"), F.bool_or((F.col("distance_m") <= merge_m) | F.col("forced")).alias("ok")).where("ok")
    ends = pairs.select(F.explode(F.array("key_a", "key_b")).alias("key")).distinct()
    seeds = components(pairs.where("forced").select(F.col("key_a").alias("a"), F.col("key_b").alias("b")))
    cluster = written(ends.join(seeds, ends.key == seeds.node, "left").select("key", F.coalesce("root", "key").alias("cluster_id")), "clusters")
    of = lambda s: cluster.select(F.col("key").alias(f"key_{s}"), F.col("cluster_id").alias(f"c_{s}"))
    across = one.join(of("a"), "key_a").join(of("b"), "key_b").select(F.col("c_a").alias("x"), F.col("c_b").alias("y"), F.lit(1).cast("long").alias("within"), "turn")
    before: list[DataFrame] = []
    for _ in range(max_rounds):
        size = cluster.groupBy("cluster_id").agg(F.count("*").alias("n"))
        edges = across.where("x <> y").groupBy(F.least("x", "y").alias("lo"), F.greatest("x", "y").alias("hi")).agg(F.sum("within").alias("within"), F.min("turn").alias("turn"))
        sized = edges.join(size.select(F.col("cluster_id").alias("lo"), F.col("n").alias("n_lo")), "lo").join(size.select(F.col("cluster_id").alias("hi"), F.col("n").alias("n_hi")), "hi")
        edges = written(sized.where("within = n_lo * n_hi").select("lo", "hi", "within", "turn"), "edges")
        open_ = edges.where("turn is not null").select("lo", "hi", "turn")
        first = open_.select(F.explode(F.array("lo", "hi")).alias("c"), "turn").groupBy("c").agg(F.min("turn").alias("first"))
        low, high = (first.select(F.col("c").alias(s), F.col("first").alias(f"first_{s}")) for s in ("lo", "hi"))
        now = open_.join(low, "lo").join(high, "hi").where("turn = first_lo and turn = first_hi")
        moves = written(now.select(F.col("hi").alias("from"), F.col("lo").alias("to")), "moves")
        if moves.isEmpty():
            for table in (*before, edges, moves):
                discard(table)
            return cluster
        joined = written(cluster.join(moves, cluster.cluster_id == moves["from"], "left").select("key", F.coalesce("to", "cluster_id").alias("cluster_id")), "clusters")
        for table in (*before, cluster):
            discard(table)
        before, cluster = [edges, moves], joined
        at = lambda s: moves.select(F.col("from").alias(s), F.col("to").alias(f"to_{s}"))
        across = edges.join(at("lo"), "lo", "left").join(at("hi"), "hi", "left").select(F.coalesce("to_lo", "lo").alias("x"), F.coalesce("to_hi", "hi").alias("y"), "within", "turn")
    raise RuntimeError("pairs are still pending")


def cluster_records(records: DataFrame, pairs: DataFrame, overrides: DataFrame | None = None, config: Config = DEFAULT, max_edges: int = 100_000) -> DataFrame:
    """key, cluster_id (the smallest key of the cluster): exactly one row for each record."""
    known = pairs.select("key_a", "key_b", "distance_m", "band").withColumn("forced", F.lit(False))
    if overrides is not None:
        forced = apply_always(records, overrides)
        far = forced.select("key_a", "key_b", F.lit(float("inf")).alias("distance_m"), F.lit("FORCED").alias("band"), F.lit(True).alias("forced"))
        known = apply_never(pairs, overrides).select("key_a", "key_b", "distance_m", "band").withColumn("forced", F.lit(False)).unionByName(far)
    known = written(known, "pairs")
    edges = written(known.where("band = 'MERGE' or forced").select("key_a", "key_b").distinct(), "edges")
    # a pair whose ends have no other pair is a cluster: it lies within the merge distance or is forced
    ends = edges.select(F.explode(F.array("key_a", "key_b")).alias("key")).groupBy("key").agg((F.count("*") == 1).alias("leaf"))
    leaf_a, leaf_b = (ends.select(F.col("key").alias(f"key_{s}"), F.col("leaf").alias(f"leaf_{s}")) for s in "ab")
    marked = written(edges.join(leaf_a, "key_a").join(leaf_b, "key_b").withColumn("alone", F.expr("leaf_a and leaf_b")), "marked")
    couples = marked.where("alone").select(F.explode(F.array("key_a", "key_b")).alias("key"), F.least("key_a", "key_b").alias("cluster_id"))
    roots = components(marked.where("not alone").select(F.col("key_a").alias("a"), F.col("key_b").alias("b")))
    node_a, node_b = (roots.select(F.col("node").alias(f"key_{s}"), F.col("root").alias(f"root_{s}")) for s in "ab")
    inside = written(known.join(node_a, "key_a").join(node_b, "key_b").where("root_a = root_b").withColumnRenamed("root_a", "root").drop("root_b"), "inside")
    large = inside.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > max_edges)
    small = inside.join(large, "root", "left_anti")
    merge_m = config.merge_m
    assigned = couples.union(_components_at_once(small, merge_m))
    if not large.isEmpty():
        assigned = assigned.union(_in_rounds(inside.join(large, "root", "left_semi"), merge_m))
    out = written(records.select("key").join(assigned, "key", "left").select("key", F.coalesce("cluster_id", "key").alias("cluster_id")), "clusters")
    for table in (known, edges, marked, inside):
        discard(table)
    return out


def review_items(pairs: DataFrame, clusters: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """key_a, key_b, distance_m, band, reason: what a person should look at, judged on the final clusters."""
    open_ = pairs
    if overrides is not None:
        open_ = apply_never(pairs, overrides)
        forced = override_pairs(overrides, "always").withColumn("forced", F.lit(True))
        open_ = open_.join(merged_in(forced), ["key_a", "key_b"], "left").where("forced is null or band = 'MERGE'").drop("forced")
    sized = clusters.withColumn("n", F.count("*").over(Window.partitionBy("cluster_id")))
    a, b = (sized.select(F.col("key").alias(f"key_{s}"), F.col("cluster_id").alias(f"c_{s}"), (F.col("n") > 1).alias(f"m_{s}")) for s in "ab")
    apart = open_.join(merged_in(a), "key_a").join(merged_in(b), "key_b").where("c_a <> c_b and not (m_a and m_b)")
    reason = F.when(F.col("band") == "REVIEW", "beyond merge threshold").when(F.col("m_a") | F.col("m_b"), "counterpart already merged").otherwise("would over-merge the cluster")
    return apart.select("key_a", "key_b", "distance_m", "band", reason.alias("reason"))


def override_status(overrides: DataFrame, records: DataFrame) -> DataFrame:
    """a, b, verdict, status: yes, stale (a key no longer exists) or not applied."""
    has = lambda s: merged_in(records.select(F.col("key").alias(s), F.lit(True).alias(f"has_{s}")))
    applied = merged_in(apply_always(records, overrides).withColumn("applied", F.lit(True)))
    found = (
        overrides.join(has("a"), "a", "left")
        .join(has("b"), "b", "left")
        .join(applied, (F.least("a", "b") == F.col("key_a")) & (F.greatest("a", "b") == F.col("key_b")), "left")
    )
    status = F.when(F.col("has_a").isNull() | F.col("has_b").isNull(), "stale").when((F.col("verdict") == "always") & F.col("applied").isNull(), "not applied").otherwise("yes")
    return found.select("a", "b", "verdict", status.alias("status"))
