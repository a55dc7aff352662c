"""Pairs and clusters: cases by hand, then random records against a sequential version."""

import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siteweave.operators import pairs, resolve
from tests.records import frame, record


@pytest.mark.parametrize("meters, band", [(60, "MERGE"), (173, "MERGE"), (245, "MERGE"), (249, "MERGE"), (251, "REVIEW"), (300, "REVIEW"), (399, "REVIEW"), (401, None), (500, None)])
def test_bands(spark, meters, band):
    found = pairs.candidate_pairs(frame(spark, [record(), record("ansg:a", meters)])).collect()
    assert [r.band for r in found] == ([band] if band else [])


def test_who_pairs(spark):
    df = frame(spark, [record(), record("pge:2", 5), record("ansg:z", 10, role="landing"), record("ansg:v", 20, approximate_location=True)])
    found = pairs.candidate_pairs(df).collect()
    assert {(r.key_a, r.key_b, r.band) for r in found} == {("ansg:v", "pge:1", "REVIEW"), ("ansg:v", "pge:2", "REVIEW")}


def test_date_line_and_poles(spark):
    df = frame(spark, [record(lat=0.0, lon=179.9999), record("ansg:a", lat=0.0, lon=-179.9999), record("pge:9", lat=89.9999, lon=0.0), record("dhv:n", lat=89.9999, lon=180.0)])
    assert {(r.key_a, r.key_b) for r in pairs.candidate_pairs(df).collect()} == {("ansg:a", "pge:1"), ("dhv:n", "pge:9")}


def test_near_equals_brute_force(spark):
    r = random.Random(5)
    rows = [record(f"{r.choice(['pge', 'ansg', 'dhv'])}:{i}", lat=lat, lon=lon) for i in range(400) for lat, lon in [(r.choice([-0.01, 46.0, 85.0, 89.99]) + r.uniform(0, 0.02), r.uniform(-0.03, 0.03) + r.choice([0, 180]))]]
    rows = [x | {"lat": min(x["lat"], 90.0), "lon": (x["lon"] + 180) % 360 - 180} for x in rows]
    df = frame(spark, rows)
    a, b = df.select(F.col("key").alias("k1"), F.col("lat").alias("y1"), F.col("lon").alias("x1"), "provider"), df.select(F.col("key").alias("k2"), F.col("lat").alias("y2"), F.col("lon").alias("x2"), F.col("provider").alias("p2"))
    from siteweave.functions.geo import haversine_m

    brute = a.crossJoin(b).where((F.col("k1") < F.col("k2")) & (F.col("provider") != F.col("p2")) & (haversine_m(F.col("y1"), F.col("x1"), F.col("y2"), F.col("x2")) <= 400))
    assert {(x.k1, x.k2) for x in brute.collect()} == {(x.key_a, x.key_b) for x in pairs.candidate_pairs(df).collect()}


def clusters(spark, rows, overrides=None, **kw):
    df = frame(spark, rows)
    found = pairs.candidate_pairs(df)
    dec = spark.createDataFrame(overrides, "a string, b string, verdict string") if overrides else None
    cl = resolve.cluster_records(df, found, dec, **kw).cache()
    return {r.key: r.cluster_id for r in cl.collect()}, resolve.review_items(found, cl, dec).collect()


@pytest.mark.parametrize(
    "rows, sizes, reasons",
    [
        ([("pge:1", 0), ("ansg:a", 120)], [2], []),
        ([("pge:1", 0), ("ansg:a", 300)], [1, 1], ["beyond merge threshold"]),
        ([("pge:1", 0), ("ansg:a", 10), ("pge:2", 300), ("ansg:b", 310)], [2, 2], []),
        ([("pge:1", 0), ("ansg:a", 33), ("pge:2", 133)], [1, 2], ["counterpart already merged"]),
    ],
)
def test_cases(spark, rows, sizes, reasons):
    found, review = clusters(spark, [record(k, m) for k, m in rows])
    assert sorted(Counter(found.values()).values()) == sizes
    assert [r.reason for r in review] == reasons


def test_chain_is_not_merged(spark):
    found, review = clusters(spark, [record("pge:1", 0), record("ansg:a", 200), record("dhv:x", 400)])
    assert sorted(Counter(found.values()).values()) == [1, 2] and review


def test_overrides(spark):
    near, far = [record("pge:1", 0), record("ansg:a", 120)], [record("pge:1", 0), record("ansg:a", 5000, role="landing")]
    found, review = clusters(spark, near, [("pge:1", "ansg:a", "never")])
    assert len(set(found.values())) == 2 and not review
    found, _ = clusters(spark, far, [("pge:1", "ansg:a", "always"), ("pge:1", "gone:1", "always")])
    assert len(set(found.values())) == 1


def sequential(rows, found, never, always):
    """One pair after the other."""
    distance = {frozenset((p.key_a, p.key_b)): p.distance_m for p in found if frozenset((p.key_a, p.key_b)) not in never}
    of = {r["key"]: {r["key"]} for r in rows}

    def join(a, b):
        both = of[a] | of[b]
        for k in both:
            of[k] = both

    for pair in sorted(map(sorted, always)):
        join(*pair)
    for p in sorted(found, key=lambda p: (p.distance_m, p.key_a, p.key_b)):
        if p.band == "MERGE" and frozenset((p.key_a, p.key_b)) not in never and of[p.key_a] is not of[p.key_b]:
            if all(frozenset((a, b)) in always or distance.get(frozenset((a, b)), 1e9) <= 250 for a in of[p.key_a] for b in of[p.key_b]):
                join(p.key_a, p.key_b)
    return {k: min(v) for k, v in of.items()}


@pytest.mark.parametrize("seed", range(3))
def test_random_records(spark, seed):
    r = random.Random(seed)
    rows = [record(f"{g}:{i}", lat=46 + r.uniform(0, 0.012), lon=11 + r.uniform(0, 0.012), approximate_location=r.random() < 0.1) for i in range(40) for g in ("pge", "ansg", "dhv", "fff")]
    df = frame(spark, rows)
    found = pairs.candidate_pairs(df).collect()
    shuffled = [(p.key_a, p.key_b) for p in found]
    r.shuffle(shuffled)
    never, always = {frozenset(p) for p in shuffled[:20]}, {frozenset(p) for p in shuffled[20:26]}
    overrides = [(*sorted(p), v) for ps, v in ((never, "never"), (always, "always")) for p in ps]
    expected = sequential(rows, found, never, always)
    assert clusters(spark, rows, overrides)[0] == expected
    if seed == 0:
        assert clusters(spark, rows, overrides, max_edges=5)[0] == expected  # decided in rounds of joins


def test_same_source_pairs(spark):
    df = frame(spark, [record("pge:1", 0, group_ids=["a"]), record("pge:2", 100, group_ids=["b"]), record("pge:3", 50, group_ids=["a"]), record("ansg:1", 0)])
    assert {(r.key_a, r.key_b) for r in pairs.same_source_pairs(df).collect()} == {("pge:1", "pge:2"), ("pge:2", "pge:3")}


def test_override_status(spark):
    df = frame(spark, [record("pge:1"), record("ansg:a")])
    dec = spark.createDataFrame([("pge:1", "ansg:a", "always"), ("pge:1", "gone:1", "never")], "a string, b string, verdict string")
    assert {(r.b, r.status) for r in resolve.override_status(dec, df).collect()} == {("ansg:a", "yes"), ("gone:1", "stale")}


def test_empty(spark):
    df = frame(spark, [])
    assert pairs.candidate_pairs(df).count() == 0
    assert resolve.cluster_records(df, pairs.candidate_pairs(df)).count() == 0


@pytest.mark.parametrize("n, share", [(60, 1.0), (60, 0.7), (220, 0.85)])
def test_large_components_in_tasks_and_in_rounds(spark, n, share):
    """A clique of 60, and one component of some 20 000 pairs, each way under a minute."""
    r = random.Random(n)
    keys = [f"k{i:03d}" for i in range(n)]
    found = [(a, b, round(r.uniform(1, 280), 1)) for i, a in enumerate(keys) for b in keys[i + 1 :] if r.random() < share]
    df = spark.createDataFrame([(a, b, d, "MERGE" if d <= 250 and r.random() < 0.9 else "REVIEW") for a, b, d in found], "key_a string, key_b string, distance_m double, band string")
    records = spark.createDataFrame([(k,) for k in keys], "key string")
    results = []
    for max_edges in (100_000, 10):
        began = time.time()
        results.append({(x.key, x.cluster_id) for x in resolve.cluster_records(records, df, max_edges=max_edges).collect()})
        assert time.time() - began < 60
    assert results[0] == results[1] and 1 < len({c for _, c in results[0]}) < n


@pytest.mark.parametrize("crowd", [1, 3, 12])
def test_cells_cut_again(spark, crowd):
    """Crowded cells at the equator, at the date line, in the north and around a pole: the same pairs as without a cut."""
    r = random.Random(crowd)
    spots = [(0.0, 10.0), (-0.001, 180.0), (46.0, 8.0), (89.996, 0.0), (-89.999, 90.0)]
    rows = []
    for i in range(250):
        lat, lon = r.choice(spots)
        lat, lon = min(max(lat + r.gauss(0, 0.003), -90.0), 90.0), lon + r.gauss(0, 0.004) * (1 if abs(lat) < 80 else 20_000)
        rows.append(record(f"{r.choice(['pge', 'ansg', 'dhv'])}:{i}", lat=lat, lon=(lon + 180) % 360 - 180, role=r.choice(["launch", "landing"])))
    rows += [record(f"{g}:same{i}", lat=46.0, lon=8.0) for g in ("pge", "dhv") for i in range(12)]  # one place
    df = frame(spark, rows)
    assert pairs.crowded_cells(df, 400.0, crowd).count() > 0 and pairs.crowded_cells(df, 400.0).count() == 0
    for f in (pairs.candidate_pairs, pairs.same_source_pairs):
        cut, plain = (Counter(map(tuple, f(df, crowd=c).collect())) for c in (crowd, 10**9))
        assert cut == plain and plain


def test_two_hundred_thousand_records_in_one_cell(spark):
    """No task has more than twice the median's rows, and every pair is found."""
    n, cell = 200_000, 0.003
    spot = spark.range(n).select(F.col("id").cast("string").alias("id"), (46.0 + cell * F.rand(1)).alias("lat"), (8.0 + cell * F.rand(2)).alias("lon"), F.when(F.col("id") % 20_000 == 7, "dhv").otherwise("pge").alias("provider"))
    df = spot.select("provider", "id", F.concat_ws(":", "provider", "id").alias("key"), F.lit("launch").alias("role"), "lat", "lon", F.lit(False).alias("approximate_location")).cache()
    assert pairs.crowded_cells(df, 400.0).agg(F.sum("n")).first()[0] == n
    left = df.select("lat", "lon", "key")
    step = pairs._step(400.0)
    cuts = pairs.crowded_cells(df, 400.0).agg(F.max("cuts")).first()[0]
    fine = left.groupBy(F.floor(F.col("lat") / step * cuts), F.floor(F.col("lon") * cuts / step)).count().agg(F.percentile_approx("count", 0.5), F.max("count")).first()
    assert cuts >= 5 and fine[1] < 2 * fine[0] + 500
    began = time.time()
    found = pairs.candidate_pairs(df)
    got = found.agg(F.count("*").alias("n"), F.sum("distance_m").alias("m")).first()
    assert time.time() - began < 90
    few = df.where("provider = 'dhv'").select(F.col("lat").alias("y"), F.col("lon").alias("x"))
    from siteweave.functions.geo import haversine_m

    meters = haversine_m(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"))
    want = df.where("provider = 'pge'").crossJoin(F.broadcast(few)).where(meters <= 400).agg(F.count("*").alias("n"), F.sum(F.round(meters, 1)).alias("m")).first()
    df.unpersist()
    assert got.n == want.n > 1_000_000 and got.m == pytest.approx(want.m)
