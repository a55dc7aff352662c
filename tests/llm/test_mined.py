"""Hard negatives, the prefix trie and language identification against brute force, with every edge case."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from siteweave.llm import langid, negatives, queries, tries

# --- hard negatives --------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int, part string, row string, score double, id int"


def brute_negatives(rows, k=5, m=3):
    clip = lambda s: max(-(2**63), min(2**63 - 1, s))
    good = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab, *_ in rows if i is not None and v is not None and lab is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, v, lab in (g for g in good if g[0] % 3 == 0):
        scored = sorted((-clip(sum(p * q for p, q in zip(v, w))), i, other == lab) for i, w, other in good if i != a)
        for s, i, _ in [x for x in scored if x[2]][:k]:
            fit = [(t, j) for t, j, alike in scored if not alike and 50 * -s <= 100 * -t <= 95 * -s][:m]
            out += [(a, i, r + 1, j, -s, -t) for r, (t, j) in enumerate(fit)]
    return Counter(out)


def vectors():
    r = random.Random(3)
    centre = [[r.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = [(i, [c + r.gauss(0, 0.8) for c in centre[i % 4]], r.randrange(3)) for i in range(150)]
    rows += [(i, [0.5, -0.25, 0.125, 1.0, 0.0, -1.0], i % 3) for i in range(150, 190)]  # one very common vector
    rows += [rows[9], rows[9], (6, [1.0] * 6, 1)]  # repeated rows, a repeated id
    rows += [(None, [1.0] * 6, 1), (200, None, 1), (201, [1.0] * 6, None), (202, [1.0, None], 0), (203, [float("nan")], 0), (204, [float("inf")], 0), (207, [1.0, 2.0], 1), (210, [], 2), (-3, [-1.0] * 9, 1)]
    return [(*x, "p", "r", 0.5, 4) for x in rows]


@pytest.mark.parametrize("least", [1024, 20])
def test_negatives_against_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(negatives, "LEAST", least)
    df = spark.createDataFrame(vectors(), VECTORS).repartition(3)
    got = Counter(map(tuple, negatives.mine(df, F.col("vec_id") % 3 == 0).collect()))
    assert got == brute_negatives(vectors())


def test_negatives_of_huge_numbers_and_of_nothing(spark):
    r = random.Random(5)
    rows = [(i, [r.choice([-1, 1]) * 10 ** r.uniform(0, 12) for _ in range(3)], i % 2, "", "", 0.0, 0) for i in range(40)]
    df = spark.createDataFrame(rows, VECTORS)
    assert Counter(map(tuple, negatives.mine(df, F.col("vec_id") % 3 == 0).collect())) == brute_negatives(rows)
    none = negatives.mine(df.limit(0), F.col("vec_id") % 3 == 0)
    assert none.collect() == [] and none.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_an_anchor_reads_little_where_lists_are_steep():
    """Sorted access stops early: rows far down the lists are never scored."""
    n = 4096
    numbers = np.zeros((n, 2))
    numbers[:, 0] = np.arange(n)
    pack = {"part": 0, "seq": 0, "n": n, "ids": np.arange(n).tobytes(), "labels": np.zeros(n, np.int64).tobytes(), "kind": "<f8", "width": 2, "numbers": numbers.tobytes()}
    anchor = pack | {"n": 1, "ids": np.array([-1]).tobytes(), "labels": np.zeros(1, np.int64).tobytes(), "numbers": np.array([[2.0, 0.0]]).tobytes()}
    (tile,) = negatives._tiles([anchor], None, 5, 50, 95)
    scored, offer = [], tile._offer
    tile._offer = lambda active, scores, ids, labels: (scored.append(len(ids)), offer(active, scores, ids, labels))
    tile.meet(negatives.Block([pack]))
    assert [r[4] for r in tile.rows()] == [n - 1, n - 2, n - 3, n - 4, n - 5] and sum(scored) <= 16


# --- prefix trie -----------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, depth int, path string, n_convs string"


def brute_trie(rows):
    own = defaultdict(list)
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    for c, turn, role, text, *_ in rows:
        if c is not None:
            r, t = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), r, digest(r, t), t))
    own = {c: [(x[1], x[3]) for x in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def conversations():
    r = random.Random(8)
    says = ["hi", "hello", "what is a gate", "é" * 7, "x" * 3000, "", "bye"]
    rows = [(c, t, r.choice(["user", "bot"]), r.choice(says)) for c in range(60) for t in range(r.randrange(1, 7))]
    rows += [(c, t, "user", "copied") for c in range(100, 160) for t in range(4)]  # a large group of copies
    rows += [(300, t, "user", f"turn {t}") for t in range(400)] + [(301, t, "user", f"turn {t}") for t in range(380)]  # long ones
    rows += [(5, 0, "user", "hi"), (5, 0, "user", "hi"), (61, None, "user", "first"), (61, 1, None, "no role"), (61, 1, "bot", None), (None, 0, "user", "nobody"), (62, 2, None, None), (400, 1, "a", "b:c"), (401, 1, "a:b", "c")]
    return [(*x, 1, "p", "n") for x in rows]


@pytest.mark.parametrize("size", [tries.SHARD_TURNS, 40])
def test_trie_against_brute_force(spark, size):
    """With small shards most boundaries share nodes, also inside the long conversations."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = tries.rebuilt_nodes(spark.createDataFrame(conversations(), TURNS).repartition(3), size).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert Counter(map(tuple, got)) == Counter((c, d, p, n, k, leaf, s, e) for c, d, p, n, k, leaf, s, e in brute_trie(conversations()))


def test_trie_of_nothing_and_of_conversations_without_turns(spark):
    assert tries.rebuilt_nodes(spark.createDataFrame([], TURNS)).collect() == []
    h = lambda c: zlib.crc32(str(c).encode()) % 9
    without = [c for c in range(1000) if c % 5 and h(c) >= 1][:3]  # their base is absent and their one turn is cut off
    rows = [(c, 0, "user", "hi", 1, "p", "n") for c in without]
    got = tries.rebuilt_nodes(spark.createDataFrame(rows, TURNS)).collect()
    assert Counter(map(tuple, got)) == brute_trie(rows) and [(r.depth, r.n_convs, r.n_leaves) for r in got] == [(0, 3, 1)]


def test_a_hot_sequence_is_put_together_in_pieces(spark, monkeypatch):
    many = spark.range(70_000).select(F.col("id").alias("conv_id"), F.unhex(F.lit("00" * 40)).alias("seq"))
    got = {r.depth: r for r in tries.nodes(many).collect()}
    assert [got[d].n_convs for d in range(3)] == [70_000] * 3 and got[2].ends_sha256 == hashlib.sha256(",".join(map(str, range(70_000))).encode()).hexdigest()


# --- language identification -----------------------------------------------------------

def test_slopes_against_differences():
    """Backpropagation through time equals the slope of the loss by small steps."""
    r = np.random.default_rng(1)
    net = langid.Network(["a", "b", "c"])
    text, language = r.integers(60, 130, (12, 5)).astype(np.uint8), r.integers(0, 3, 5)

    def loss():
        p, _, _ = net.probabilities(text)
        letters = langid.LETTER[text]
        return -(np.log(p[:, language, np.arange(5)].astype(np.float64)) * letters).sum() / letters.sum()

    for owner, name, slope in net.slopes(text, language):
        weights = getattr(owner, name)
        flat = int(np.abs(slope).argmax())
        at = np.unravel_index(flat, weights.shape)
        was, step = weights[at], 1e-2
        weights[at] = was + step
        up = loss()
        weights[at] = was - step
        down = loss()
        weights[at] = was
        assert (up - down) / (2 * step) == pytest.approx(float(slope[at]), rel=0.03, abs=2e-4), name


def test_every_byte_is_read_once():
    sizes = np.array([0, 1, 63, 64, 65, 200])
    of, start, length = langid.cut(sizes)
    assert np.bincount(of, length, 6).tolist() == sizes.tolist() and all(s % langid.WIDTH == 0 for s in start)
    net = langid.Network(["a", "b"])
    data = np.frombuffer(b"abc def" * 30, np.uint8)
    whole = net.documents(data, np.array([0, 0]), np.array([210, 70]))
    again = net.documents(data, np.array([0]), np.array([210]))
    assert np.allclose(whole[0], again[0], atol=1e-6) and np.allclose(whole.sum(1), 1, atol=1e-5)


def language_rows():
    r = random.Random(4)
    parts = {"xx": "wamo lika teso nuri".split(), "yy": "grunt schtof krieg plompf".split(), "zz": "éàü ôçè îâê ñõã".split()}
    rows = [(i, " ".join(r.choice(parts[lang]) for _ in range(r.choice([3, 40, 300]))), lang, "s", 1) for i in range(240) for lang in [r.choice(["xx", "xx", "xx", "yy", "zz"])]]
    rows += [(1000 + i, None, "xx", "s", 1) for i in range(3)] + [(1010, "", "yy", "s", 1), (1011, " 12 - 34 !", "yy", "s", 1), (1012, "grunt krieg", None, "s", 1), (None, "wamo", "xx", None, 1), (1013, "lika " * 9000, "xx", "s", 1)]
    return rows + [rows[0], rows[0]]


LANGUAGES = "doc_id long, text string, lang string, held_out string, score int"


def test_languages_of_odd_rows(spark):
    docs = spark.createDataFrame(language_rows(), LANGUAGES).repartition(3)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    rows = langid.identified(docs, held).collect()
    assert len(rows) == len(language_rows()) and Counter(r.doc_id for r in rows) == Counter(x[0] for x in language_rows())
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    want = {x[0]: x[2] for x in language_rows() if x[0] is not None and x[0] < 1000}
    right = [r.lang_pred == want[r.doc_id] for r in rows if r.held_out and r.doc_id in want]
    assert len(right) > 30 and np.mean(right) > 0.95
    odd = {r.doc_id: (r.lang_pred, r.score) for r in rows if r.doc_id is None or r.doc_id >= 1000}
    assert all(odd[i] == ("und", 0) for i in (1000, 1001, 1002, 1010, 1011)) and odd[1012][0] == "yy" and odd[1013][0] == "xx" and odd[None][0] == "xx"


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame(language_rows(), LANGUAGES)
    assert {r.lang_pred for r in langid.identified(docs.withColumn("lang", F.lit(None).cast("string")), F.lit(False)).collect()} == {"und"}
    assert langid.identified(docs.limit(0), F.lit(False)).collect() == []


def test_the_sample_is_bounded_and_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame(language_rows(), LANGUAGES)
    some = langid.sample(docs, F.col("doc_id") % 2 == 0, "doc_id", "text", "lang", 10, 3).collect()
    count = Counter(r.lang for r in some)
    assert set(count) == {"xx", "yy", "zz"} and max(count.values()) <= 30 and all(len(r.window) <= langid.WIDTH for r in some)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    rows = queries.op12_language_id(spark, sf).where("held_out and lang_pred <> 'und'").join(docs, "doc_id").collect()
    assert len(rows) > 150 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
