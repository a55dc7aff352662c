"""Items of large JSON documents, cut at every place, against a JSON parser."""

import json
import os
import random
import time

import pytest

from siteweave.functions.geo import WORLD
from siteweave.plans.store import new_path
from siteweave.sources import readers
from siteweave.sources.documents import array_items


def write(spark, **files):
    path = new_path(spark, "json").removeprefix("file://")
    os.makedirs(path)
    for name, text in files.items():
        with open(f"{path}/{name}.json", "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return path


def odd(r, depth=0):
    """A value with marks of structure inside strings, escapes and nesting."""
    text = "".join(r.choice(['{', '}', '[', ']', ':', ',', '"', "\\", "é", "}}", 'a":{', "\n", "x"]) for _ in range(r.randrange(12)))
    kinds = [text, r.random(), None, True, -5, {}, []]
    if depth < 3:
        kinds += [{f"k{r.choice('ab}{')}{i}": odd(r, depth + 1) for i in range(r.randrange(4))}, [odd(r, depth + 1) for _ in range(r.randrange(4))]]
    return r.choice(kinds)


def document(r):
    items = lambda: [x for _ in range(r.randrange(30)) for x in [{"n": r.randrange(10**6), "v": odd(r), "features": [{"no": 1}]}]]
    doc = {"type": odd(r), "meta": {"features": [{"not": "this"}], "q": odd(r)}, "features": items(), "between": odd(r), "shapes": items(), "end": odd(r)}
    return doc


@pytest.fixture
def small_ranges(spark):
    def put(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")

    yield put
    for name in ("maxPartitionBytes", "openCostInBytes"):
        spark.conf.unset(f"spark.sql.files.{name}")


@pytest.mark.parametrize("size,seed", [(40, 1), (333, 2), (5000, 3), (1 << 27, 4)])
def test_items_of_documents_cut_anywhere(spark, small_ranges, size, seed):
    r = random.Random(seed)
    docs = {f"d{i}": document(r) for i in range(3)}
    say = [lambda d: json.dumps(d), lambda d: json.dumps(d, indent=2, ensure_ascii=False) + "\n", lambda d: json.dumps(d, separators=(",", ":"), ensure_ascii=False) + "\n\n"]
    path = write(spark, **{n: say[i](d) for i, (n, d) in enumerate(docs.items())})
    small_ranges(size)
    rows = sorted(array_items(spark, path, "features", "shapes").collect(), key=lambda x: (x.file, x.range, x.nth))
    for name in ("features", "shapes"):
        got = [(os.path.basename(x.file)[:-5], json.loads(x.body)) for x in rows if x.name == name]
        assert got == [(n, item) for n, d in docs.items() for item in d[name]]
    if size < 1000:
        assert len({x.range for x in rows}) > 5


def test_documents_without_items(spark):
    path = write(spark, a="", b="{}", c='{"features": []}', d='{"other": [{"a": 1}]}', e='{"features": [1, null, "x}{"]}', f=' \n')
    assert array_items(spark, path, "features").collect() == []


def test_a_document_that_ends_inside_a_value(spark):
    for text in ('{"features": [{"a": 1}', '{"features": [{"a": "1'):
        with pytest.raises(ValueError, match="ends inside"):
            array_items(spark, write(spark, a=text), "features")


def landing(k, place, site=None):
    return {"properties": {"pge_site_id": site or str(k), "name": f"T{k}", "landing": {"landing_lat": f"{-30 + place / 1000}", "landing_lng": "150.5", "landing_name": f"N{k}"}}}


def test_the_first_takeoff_of_several_files(spark, small_ranges):
    """The landing is named by the first takeoff of the first file, whichever file is read first or cut where."""
    one = {"features": [landing(k, k % 4) for k in range(1, 40)]}
    two = {"features": [landing(k, k % 5) for k in range(40, 80)]}
    path = write(spark, b=json.dumps(one), a=json.dumps(two))
    results = []
    for size in (100, 1 << 27):
        small_ranges(size)
        rows = readers.read_feature_landings(spark, path, WORLD).collect()
        results.append(sorted((x.id, x.name, tuple(x.group_ids)) for x in rows))
    order = [*range(40, 80), *range(1, 40)]
    place = {k: k % 5 if k >= 40 else k % 4 for k in order}
    want = sorted((f"{ks[0]}-lz", f"N{ks[0]}", tuple(map(str, ks))) for p in range(5) for ks in [[k for k in order if place[k] == p]])
    assert results == [want, want]


def test_polygons_of_several_files(spark, small_ranges):
    site = lambda i, *shapes: {"id": f"s{i}", "landing": f"prose {i}" if i % 2 else " ", "mapShapeIds": list(shapes)}
    shape = lambda i: {"id": i, "name": f"LZ {i}", "category": {"name": "Landing"}, "coordinatesList": ["150.5,-30 150.7,-30.2"]}
    path = write(spark, b=json.dumps({"sites": [site(1, 7, 8), site(2, 7)], "mapShapes": [shape(7)]}), a=json.dumps({"sites": [site(4, 7), site(3, 8, 7)], "mapShapes": [shape(8), shape(9)]}))
    small_ranges(60)
    rows = {x.id: x for x in readers.read_polygon_landings(spark, path, WORLD).collect()}
    assert {i: (x.group_ids, x.notes, x.url.rsplit("/", 1)[1]) for i, x in rows.items()} == {"lz-7": (["s4", "s3", "s1", "s2"], "prose 3", "s4"), "lz-8": (["s3", "s1"], "prose 3", "s3")}


def test_a_large_document_is_read_by_several_tasks(spark):
    """120 MB in one line, ranges of 8 MB: as many tasks, no row lost."""
    n, item = 120_000, {"id": "x", "geometry": {"coordinates": [150.5, -30.5]}, "properties": {"name": "N" * 850}}
    body = json.dumps(item)[1:]
    path = write(spark, big='{"type": "FeatureCollection", "features": [' + ",".join(f'{{"n": {i}, {body}' for i in range(n)) + "]}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8m")
    began = time.time()
    try:
        rows = array_items(spark, path, "features")
        seen = rows.groupBy("range").count().collect()
        assert sum(r["count"] for r in seen) == n and len(seen) >= 12 and max(r["count"] for r in seen) < 2 * sorted(r["count"] for r in seen)[len(seen) // 2]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert time.time() - began < 120
