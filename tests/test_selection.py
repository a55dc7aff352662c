"""Country, ranking, gap-filling, ids and gates."""

import random
import time

import pytest

from siteweave.config import Config
from siteweave.operators import gates, select
from tests.records import frame, record


def canonical(spark, *rows, config=Config()):
    df = frame(spark, rows)
    clusters = spark.createDataFrame([(r["key"], "c") for r in rows], "key string, cluster_id string")
    return select.select_canonical(select.members(df, clusters), config).first()


def test_national_guide_wins(spark):
    s = canonical(spark, record(name="P"), record("ansg:a", 10, name="A", wind={}, altitude=436.0))
    assert (s.primary, s["name"], s.wind, s.altitude, s.ref) == ("ansg", "A", {"N": 1, "NE": 2}, 436.0, "pge:1")


def test_gaps(spark):
    s = canonical(spark, record(closed="shut", tow=True, notes="n", group_ids=["1"]), record("ansg:a", wind={"S": 1}, group_ids=["7", "2"]))
    assert (s.wind, s.closed, s.tow, s.notes) == ({"S": 1}, "shut", True, "n")
    assert s.group == ["ansg:2", "ansg:7", "pge:1"] and s.sources == {"ansg": "a", "pge": "1"}
    assert canonical(spark, record(role="landing")).wind == {}


@pytest.mark.parametrize("turn", [0, 1])
def test_country_of_the_scoped_guide(spark, turn):
    rows = [record(country="NZ"), record("ansg:a", country="AU")]
    s = canonical(spark, *(rows if turn else rows[::-1]))
    assert (s.country, s.primary) == ("AU", "ansg")


def test_two_scoped_guides(spark):
    config = Config(scope={"ansg": ("AU",), "aaa": ("AU",)})
    assert canonical(spark, record("aaa:1"), record("ansg:a"), config=config).primary == "ansg"
    assert canonical(spark, record(country="FR"), record("ansg:a", country="FR")).primary == "pge"


def ids(spark, clusters, registry, next_id):
    cl = spark.createDataFrame([(c, k) for c, keys in clusters.items() for k in keys], "cluster_id string, key string")
    reg = spark.createDataFrame(list(registry.items()), "key string, canonical_id string")
    return {r.cluster_id: r.canonical_id for r in select.assign_ids(cl, reg, next_id).collect()}


def test_ids(spark):
    assert ids(spark, {"a": ["pge:1"], "b": ["pge:2"]}, {}, 1) == {"a": "SITE-000001", "b": "SITE-000002"}
    assert ids(spark, {"a": ["pge:1", "ansg:a"]}, {"pge:1": "SITE-000001"}, 2) == {"a": "SITE-000001"}
    assert ids(spark, {"a": ["pge:1", "ansg:a"]}, {"pge:1": "SITE-000002", "ansg:a": "SITE-000001"}, 3) == {"a": "SITE-000001"}
    split = ids(spark, {"x": ["pge:1"], "y": ["ansg:a"]}, {"pge:1": "SITE-000001", "ansg:a": "SITE-000001"}, 2)
    assert split == {"y": "SITE-000001", "x": "SITE-000002"}


def test_ids_of_a_chain_longer_than_the_rounds(spark):
    cl = spark.createDataFrame([("c0", "k0")] + [(f"c{i}", f"k{i}{x}") for i in range(1, 6) for x in "ab"], "cluster_id string, key string")
    known = [("k0", "SITE-000001")] + [(f"k{i}{x}", f"SITE-{i + (x == 'b'):06d}") for i in range(1, 6) for x in "ab"]
    reg = spark.createDataFrame(known, "key string, canonical_id string")
    got = {r.cluster_id: r.canonical_id for r in select.assign_ids(cl, reg, 50).collect()}
    assert got == {f"c{i}": f"SITE-{i + 1:06d}" for i in range(6)}
    with pytest.raises(RuntimeError):
        select.assign_ids(cl, reg, 50, max_rounds=2)


def test_ids_against_the_loop(spark):
    import random

    r = random.Random(1)
    keys = [f"k:{i:03d}" for i in range(120)]
    clusters, registry = {}, {k: f"SITE-{r.randrange(1, 40):06d}" for k in keys if r.random() < 0.8}
    for k in keys:
        clusters.setdefault(f"c{r.randrange(60)}", []).append(k)
    taken, expected, n = set(), {}, 500
    for c in sorted(clusters, key=lambda c: min(clusters[c])):
        free = sorted({registry[k] for k in clusters[c] if k in registry} - taken)
        if free:
            expected[c] = free[0]
        else:
            expected[c], n = f"SITE-{n:06d}", n + 1
        taken.add(expected[c])
    assert ids(spark, clusters, registry, 500) == expected


def loop(clusters, registry, n):
    taken, expected = set(), {}
    for c in sorted(clusters, key=lambda c: min(clusters[c])):
        free = sorted({registry[k] for k in clusters[c] if k in registry} - taken)
        expected[c], n = (free[0], n) if free else (f"SITE-{n:06d}", n + 1)
        taken.add(expected[c])
    return expected


def test_ids_of_a_chain_of_two_thousand(spark):
    """Every cluster knows its own id and that of the one before it; the last of all finds nothing left."""
    keys = {f"c{i}": [f"k{i:05d}a", f"k{i:05d}b"] for i in range(2000)} | {"c2000": ["k02000a"]}
    known = {f"k{i:05d}{x}": f"SITE-{max(i + (x == 'a'), 1):06d}" for i in range(2000) for x in "ab"} | {"k02000a": "SITE-002000"}
    began = time.time()
    assert ids(spark, keys, known, 5000) == loop(keys, known, 5000)
    assert time.time() - began < 30


@pytest.mark.parametrize("max_edges", [500_000, 12])
def test_ids_of_components_in_tasks_and_in_rounds(spark, max_edges):
    r = random.Random(6)
    keys = [f"k:{i:03d}" for i in range(200)]
    registry = {k: f"SITE-{r.randrange(1, 110):06d}" for k in keys if r.random() < 0.9}
    clusters = {}
    for k in keys:
        clusters.setdefault(f"c{r.randrange(120)}", []).append(k)
    cl = spark.createDataFrame([(c, k) for c, ks in clusters.items() for k in ks], "cluster_id string, key string")
    got = select.assign_ids(cl, spark.createDataFrame(list(registry.items()), "key string, canonical_id string"), 500, max_edges=max_edges)
    assert {x.cluster_id: x.canonical_id for x in got.collect()} == loop(clusters, registry, 500)


def catalogue(spark, n, start=0, provider="pge", role="launch", key=None):
    return [(f"{provider}:{key or ''}{i}", -30 + i * 0.01, 150.0, [provider], role) for i in range(start, start + n)]


def health(spark, new, old):
    schema = "ref string, lat double, lon double, providers array<string>, role string"
    rows = gates.output_health(spark.createDataFrame(new, schema), spark.createDataFrame(old, schema)).collect()
    return {r.gate for r in rows if not r.ok}, rows


def test_gates(spark):
    old = catalogue(spark, 200)
    assert health(spark, catalogue(spark, 199), old)[0] == set()
    assert "count" in health(spark, catalogue(spark, 150), old)[0]
    assert "key churn" in health(spark, catalogue(spark, 200, key="n"), old)[0]
    moved = [(r, 47.0, 12.0, p, t) if r == "pge:0" else (r, la, lo, p, t) for r, la, lo, p, t in old]
    assert health(spark, moved, old)[0] == {"key moves"}
    near = [(r, la + 0.009, lo, p, t) if r == "pge:0" else (r, la, lo, p, t) for r, la, lo, p, t in old]
    assert health(spark, near, old)[0] == set()
    two = old + catalogue(spark, 40, provider="dhv")
    assert health(spark, two, old)[0] == set()  # a new guide explains the growth, once
    assert "count" in health(spark, two + catalogue(spark, 40, 40, provider="dhv"), two)[0]
    assert "provider drop" in health(spark, old, two)[0]
    assert health(spark, old + catalogue(spark, 80, provider="pge", role="landing", key="l"), old)[0] == set()
    assert "count" in health(spark, catalogue(spark, 150) + catalogue(spark, 60, provider="dhv"), old)[0]
    assert [r.gate for r in health(spark, old, [])[1]] == ["first run"]


def test_source_health(spark):
    stats = spark.createDataFrame([("ansg", 0), ("pge", 100), ("dhv", 5)], "provider string, record_count long")
    last = spark.createDataFrame([("ansg", 245), ("pge", 110)], "source string, record_count long")
    assert {r.source: r.ok for r in gates.source_health(stats, last).collect()} == {"ansg": False, "pge": True, "dhv": True}
    with pytest.raises(ValueError):
        gates.require(spark.createDataFrame([("count", False, 0.5, 0.05, "x")], "gate string, ok boolean, value double, limit double, detail string"))
