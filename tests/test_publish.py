"""Incremental shards, the publish gate, guide checks and unique keys."""

import os

import pytest
from pyspark.sql import functions as F

from siteweave.config import Config
from siteweave.functions.geo import WORLD, Box
from siteweave.operators import publish, reports, select
from siteweave.plans.store import new_path, small_text, switch
from siteweave.sources import readers, sinks
from tests.records import frame, record

GUIDES = "name string, label string, full_name string, homepage string, site_url_template string, licence string, licence_url string"


def guides(spark, *names, **changed):
    return spark.createDataFrame([(n, "L", "Full", "https://x", changed.get(n, "https://x/{id}"), None, None) for n in names], GUIDES)


def sites(spark, rows):
    df = frame(spark, rows)
    clusters = df.select("key", F.col("key").alias("cluster_id"))
    ids = df.select(F.col("key").alias("cluster_id"), F.format_string("SITE-%06d", F.regexp_extract("id", r"\d+", 0).cast("int")).alias("id"))
    return select.select_canonical(select.members(df, clusters)).join(ids, "cluster_id")


def many(country="AU", n=60, start=0, **more):
    return [record(f"pge:{start + i}", i, country=country, id=str(start + i), name=f"Site {start + i}", **more) for i in range(n)]


def files(path):
    """Names and times of the files below, without sums."""
    path = path.removeprefix("file://")
    return {os.path.join(d, f)[len(path) :]: os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.startswith("part-")}


def test_unchanged_shards_keep_their_files(spark):
    path = new_path(spark, "shards")
    au, nz, fr = many(), many("NZ", 5, 100), many("FR", 5, 200)
    assert {r.country: r.status for r in sinks.write_country_shards(sites(spark, au + nz + fr), path).collect()} == {"au": "written", "nz": "written", "fr": "written"}
    before = files(path)
    de = many("DE", 3, 300)
    nz[0]["name"] = "New name"
    assert {r.country: r.status for r in sinks.write_country_shards(sites(spark, au + nz + de), path).collect()} == {"au": "unchanged", "nz": "written", "fr": "removed", "de": "written"}
    after = files(path)
    of = lambda found, c: {k: v for k, v in found.items() if f"country={c}/" in k}
    assert of(after, "au") == of(before, "au") != {} and not of(after, "fr") and of(after, "de") and of(after, "nz").keys().isdisjoint(of(before, "nz"))
    rows = spark.read.schema("value string, country string").text(path).select("country", F.get_json_object("value", "$.name").alias("name")).collect()
    assert sorted(r.name for r in rows if r.country == "nz") == sorted(r["name"] for r in nz) and len(rows) == 68
    assert {r.status for r in sinks.write_country_shards(sites(spark, au + nz + de), path).collect()} == {"unchanged"} and files(path) == after


def catalogue(spark, root):
    return sorted((r.country, r.name) for r in publish.read_shards(spark, root).select("country", F.get_json_object("value", "$.name").alias("name")).collect())


def test_a_failing_gate_leaves_the_old_catalogue(spark):
    root = new_path(spark, "root")
    assert publish.current(spark, root) is None and publish.read_shards(spark, root).count() == 0
    publish.publish(sites(spark, many() + many("NZ", 60, 100)), root)
    run, was = publish.current(spark, root), catalogue(spark, root)
    assert len(was) == 120
    with pytest.raises(ValueError, match="count"):
        publish.publish(sites(spark, many()), root)  # half of the rows are gone
    assert publish.current(spark, root) == run and catalogue(spark, root) == was
    refused = [r for r in os.listdir(f"{root}/runs".removeprefix("file://")) if r != run]
    assert len(refused) == 1 and os.listdir(f"{root}/runs/{refused[0]}".removeprefix("file://")) == ["verdict"]


def test_a_run_lost_before_the_switch_is_never_seen(spark, monkeypatch):
    root = new_path(spark, "root")
    publish.publish(sites(spark, many()), root)
    run, was = publish.current(spark, root), catalogue(spark, root)
    monkeypatch.setattr(publish, "switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    changed = many()
    changed[3]["name"] = "Another"
    with pytest.raises(OSError):
        publish.publish(sites(spark, changed), root)
    assert publish.current(spark, root) == run and catalogue(spark, root) == was
    monkeypatch.undo()
    publish.publish(sites(spark, changed), root)
    assert ("au", "Another") in catalogue(spark, root)
    publish.expire(spark, root)
    assert len(os.listdir(f"{root}/runs".removeprefix("file://"))) == 1 and len(catalogue(spark, root)) == 60


def test_two_runs_at_once(spark, monkeypatch):
    """The run that ends later would undo the other's shards, so it isn't published."""
    root = new_path(spark, "root")
    publish.publish(sites(spark, many()), root)
    first, second = many(), many()
    first[1]["name"], second[2]["name"] = "One", "Two"
    judge = publish.gates.require

    def meanwhile(verdict):
        monkeypatch.setattr(publish.gates, "require", judge)
        publish.publish(sites(spark, first), root)

    monkeypatch.setattr(publish.gates, "require", meanwhile)
    with pytest.raises(RuntimeError, match="meanwhile"):
        publish.publish(sites(spark, second), root)
    assert ("au", "One") in catalogue(spark, root) and ("au", "Two") not in catalogue(spark, root)


def test_a_manifest_names_old_and_new_folders(spark):
    root = new_path(spark, "root")
    nz = many("NZ", 60, 100)
    publish.publish(sites(spark, many() + nz), root)
    first = publish.current(spark, root)
    nz[0]["name"] = "New name"
    status = publish.publish(sites(spark, many() + nz), root)
    assert {r.country: r.status for r in status.collect()} == {"au": "unchanged", "nz": "written"}
    second = publish.current(spark, root)
    assert {r.country: r.folder.split("/")[1] for r in publish.manifest(spark, root).collect()} == {"au": first, "nz": second}
    assert ("nz", "New name") in catalogue(spark, root) and len(catalogue(spark, root)) == 120
    again = publish.publish(sites(spark, many() + nz), root)
    assert {r.status for r in again.collect()} == {"unchanged"} and publish.current(spark, root) == second
    assert publish.expire(spark, root) and len(catalogue(spark, root)) == 120


def test_switch_replaces_at_once(spark):
    path = new_path(spark, "small")
    assert small_text(spark, path) is None
    for text in ("one", "two"):
        switch(spark, path, text)
        assert small_text(spark, path) == text


def test_the_whole_run(spark):
    """Ids are carried from run to run, guides are checked first, sources before the match."""
    root = new_path(spark, "root")
    rows = many(n=100)
    source = lambda rows: {"pge": (WORLD, lambda box: frame(spark, rows)), "dhv": (Box(45.0, 5.0, 55.0, 17.0), lambda box: 1 / 0)}  # noqa: E731  the second is outside the scope
    scope = Box(-60.0, 100.0, 0.0, 180.0)
    two = guides(spark, "pge", "dhv")
    counts = {r.metric: r.value for r in publish.run(spark, root, source(rows), two, scope=scope, dry_run=True).collect()}
    assert counts["records of pge"] == 100 and counts["clusters"] + counts["merged"] >= 100 and publish.current(spark, root) is None
    publish.run(spark, root, source(rows), two, scope=scope, versions=spark.createDataFrame([("pge", "v1")], "source string, version_id string"))
    ids = {r.key: r.canonical_id for r in publish.published_table(spark, root, "registry", "key string, canonical_id string").collect()}
    assert len(ids) == 100
    publish.run(spark, root, source(rows[1:] + many(n=1, start=500)), two, scope=scope)
    later = {r.key: r.canonical_id for r in publish.published_table(spark, root, "registry", "key string, canonical_id string").collect()}
    assert later == ids | {"pge:500": "SITE-000101"}
    assert [tuple(r) for r in publish.published_table(spark, root, "state", "source string, record_count bigint, version_id string").collect()] == [("pge", 100, "v1")]
    run = publish.current(spark, root)
    with pytest.raises(ValueError, match="lost 50%"):
        publish.run(spark, root, source(rows[:50]), two, scope=scope)
    with pytest.raises(ValueError, match="dhv: no site_url_template"):
        publish.run(spark, root, source(rows), guides(spark, "pge", "dhv", dhv=" "), scope=scope)
    with pytest.raises(ValueError, match="zzz: unranked"):
        publish.run(spark, root, source(rows) | {"zzz": (WORLD, None)}, guides(spark, "pge", "dhv", "zzz"), scope=scope)
    assert publish.current(spark, root) == run


def test_guide_violations(spark):
    names = spark.createDataFrame([("pge",), ("aaa",), ("gone",)], "name string")
    got = {tuple(r) for r in readers.guide_violations(names, guides(spark, "pge", "aaa", pge=None), Config()).collect()}
    assert got == {("pge", "no site_url_template"), ("aaa", "unranked"), ("gone", "unranked"), *(("gone", f"no {c}") for c in readers.IDENTITY)}


def test_reading_a_repeated_key_fails(spark):
    rows = {"pge": (WORLD, lambda box: frame(spark, many(n=5)))}
    union = readers.union_records(rows | {"ansg": (WORLD, lambda box: frame(spark, many(n=1, start=3)))}, WORLD)
    for read in (lambda: union.collect(), lambda: union.select("name").collect(), lambda: union.count()):
        with pytest.raises(Exception, match="key occurs more than once or is null: 1 values, such as pge:3"):
            read()
    assert readers.union_records(rows, WORLD).count() == 5
    assert readers.with_unique(frame(spark, many(n=5)).limit(0)).count() == 0
    with pytest.raises(Exception, match="null"):
        readers.with_unique(frame(spark, many(n=2)).withColumn("key", F.lit(None).cast("string"))).count()


def test_override_entries(spark):
    records = frame(spark, [record("pge:1", name="Long Reef NE", url="https://x/1"), record("ansg:a", name="Long Reef SE", url=None)])
    said = [("pge:1", "ansg:a", "never", "north | south"), ("pge:999", "ansg:a", "never", None), ("ansg:a", "pge:1", "always", "one")]
    rows = reports.override_entries(spark.createDataFrame(said, "a string, b string, verdict string, reason string"), records).collect()
    got = {(r.verdict, r.nth): (r.first, r.second, r.reason, r.status) for r in rows}
    assert got == {
        ("never", 1): ("**ansg** Long Reef SE", "**pge** [Long Reef NE](https://x/1)", "north \\| south", "yes"),
        ("never", 2): ("**ansg** Long Reef SE", "`pge:999`", "—", "stale"),
        ("always", 1): ("**ansg** Long Reef SE", "**pge** [Long Reef NE](https://x/1)", "one", "yes"),
    }
    assert reports.override_entries(spark.createDataFrame([], "a string, b string, verdict string, reason string"), records).collect() == []
