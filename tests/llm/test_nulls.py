"""Null keys, null item ids and folders in use: nothing is lost, nothing is mixed."""

import random
import zlib

import numpy as np
import pytest

from siteweave.llm import decontaminate, packing, pii, queries, shards, suffixes, tokens, windows
from siteweave.plans.store import new_path


def words(r, n):
    return " ".join(f"w{r.randrange(5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def shared():
    r = random.Random(2)
    passage = words(r, 80)
    return [words(r, 40) + " " + passage + " " + words(r, 30), words(r, 20) + " " + passage, words(r, 90)]


@pytest.mark.parametrize("ids", [(None, 1, 2), (None, None, 2), (None, None, None)])
def test_passages_of_texts_without_a_key(spark, shared, ids):
    docs = spark.createDataFrame(list(zip(ids, shared)), "doc_id long, text string")
    exact = sorted((r.n_words, r.n_repeated_words) for r in suffixes.repeated_passages(docs).collect())
    assert exact == [(90, 0), (100, 80), (150, 80)]
    near = sorted((r.n_words, r.n_near_words) for r in windows.near_passages(docs).collect())
    assert [n for n, _ in near] == [90, 100, 150] and near[0][1] == 0 and all(n >= 80 for _, n in near[1:])


@pytest.mark.parametrize("hot", [2, 50_000])
def test_crowded_passages_hot_or_not(spark, monkeypatch, hot):
    """Names that are sent to the rows and names that are joined give the same spans."""
    r = random.Random(4)
    common, rare = words(r, 60), words(r, 70)
    texts = [words(r, 30) + " " + common + " " + words(r, 20) for _ in range(12)] + [rare + " " + words(r, 9), words(r, 8) + " " + rare, words(r, 60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(suffixes, "HOT", hot)
    got = {x.doc_id: x.spans for x in suffixes.repeated_passages(docs, crowd=1).collect()}
    assert got == {i: "30-90" for i in range(12)} | {12: "0-70", 13: "8-78", 14: ""} == {x.doc_id: x.spans for x in suffixes.repeated_passages(docs).collect()}


def test_sequences_of_texts_without_a_key(spark, shared):
    docs = spark.createDataFrame([(None, shared[0]), (None, shared[1]), (3, None)], "doc_id long, text string")
    encode = lambda t: [*tokens.encoder(tokens.default_path()).tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
    crc = sorted((zlib.crc32(np.array(encode(t), "<u4").tobytes()) for t in (shared[0], shared[1], "")))
    assert sorted(r.ids_crc32 for r in packing.packed(docs).collect() if r.length == r.doc_tokens) == crc
    assert sorted(r.ids_crc32 for r in shards.materialise(docs).collect()) == crc


def test_an_item_without_an_id(spark, shared):
    docs = spark.createDataFrame([(1, shared[0])], "doc_id long, text string")
    items = spark.createDataFrame([(None, shared[1]), ("a", "nothing of this")], "item_id string, text string")
    (row,) = decontaminate.report(docs, items).collect()
    assert (row.n_hit, row.n_items, row.contaminated) == (80, 0, True)


def test_a_folder_with_shards_is_refused(spark, shared):
    out = new_path(spark, "named")
    first = shards.materialise(spark.createDataFrame([(1, shared[0])], "doc_id long, text string"), out)
    was = shards.read_sequences(out, 0, 5)
    with pytest.raises(ValueError, match="isn't empty"):
        shards.materialise(spark.createDataFrame([(1, shared[1])], "doc_id long, text string"), out)
    assert first.count() == 1 and (shards.read_sequences(out, 0, 5) == was).all()


def test_several_shards_in_a_task(spark, monkeypatch):
    """Many small shards in few tasks: every sequence is in its place."""
    r = random.Random(9)
    docs = spark.createDataFrame([(i, words(r, 60)) for i in range(200)], "doc_id long, text string")
    monkeypatch.setattr(shards, "TASKS", 1)
    out = new_path(spark, "many")
    rows = shards.materialise(docs, out, length=64, shard_bytes=512).collect()
    assert len({x.shard for x in rows}) > 20
    for x in rows[:40]:
        ids = shards.read_sequences(out, x.slot, 1, 64, 512)[0][x.offset : x.offset + x.length]
        assert zlib.crc32(ids.astype("<u4").tobytes()) == x.ids_crc32


def test_no_constant_key(spark):
    assert queries.pseudonym_key(spark) != queries.pseudonym_key(spark)
    spark.conf.set("spark.siteweave.pseudonym.key", "own")
    try:
        assert queries.pseudonym_key(spark) == "own"
    finally:
        spark.conf.unset("spark.siteweave.pseudonym.key")


def test_days_are_permuted_one_to_one(spark):
    """Every day becomes a day, equal days stay equal, unlike days stay unlike."""
    days = [f"{y:04d}-{m:02d}-{d:02d}" for y in (1999, 2020) for m in range(1, 13) for d in (1, 15, 28)]
    docs = spark.createDataFrame([(i, f"on {d} and {d}.") for i, d in enumerate(days)], "doc_id long, text string")
    import re
    from datetime import date

    got = {}
    for r in pii.pseudonymised(docs, "key").collect():
        a, b = re.findall(r"\d{4}-\d{2}-\d{2}", r.text)
        date.fromisoformat(a)
        assert a == b
        got[r.doc_id] = a
    assert len(set(got.values())) == len(days) and sum(got[i] == d for i, d in enumerate(days)) <= 1
