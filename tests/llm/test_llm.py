"""The corpus operators against brute force on a small fixture with every edge case."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from siteweave.llm import decontaminate, lm, packing, passages, pii, quality, shards, simhash, suffixes, tokens, urls, windows

WORDS = "the of and wind hill slope field north gate river stone cloud glider lands early late under over meadow ridge thermal valley grass road café über été".split()


def prose(r, n):
    return " ".join(r.choice(WORDS) + r.choice(["", "", "", ",", "."]) + str(r.randrange(40)) * (r.random() < 0.4) for _ in range(n))


def make_docs():
    r = random.Random(11)
    texts = [prose(r, r.choice([5, 60, 120, 400])) for _ in range(40)]
    long = prose(r, 9000)
    passage = prose(r, 70)
    texts += [long, texts[3], texts[3], long + " tail"]  # copies and a near copy
    texts += [prose(r, 40) + " " + passage + "\n" + prose(r, 30) for _ in range(4)]
    edited = texts[-1].split()
    edited[60] = "changed"
    texts.append(" ".join(edited[:100]) + " " + prose(r, 60))
    texts += [None, "", "  \t\n ", "one", "same " * 300, "A\nA\nA\n\nB", "x" * 5000, "###$$$ %% && <tag> | *", "Lone <|endoftext|> mark  two  blanks \n x", "SHOUT " * 80]
    rows = [(i, t, "en", f"src{i % 3}") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (7, texts[8], None, None)]  # repeated rows, a repeated id
    return rows


ROWS = make_docs()
SCHEMA = "doc_id long, text string, lang string, th string"  # th clashes with a name used inside


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text):
    return (text or "").encode().lower().split()


def rowset(rows):
    return Counter(map(tuple, rows))


# --- quality rules ---------------------------------------------------------------------

def test_quality(docs, none):
    expected = Counter()
    for i, t, *_ in ROWS:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t or "") if x]
        lines, seen, dup = (t or "").split("\n"), set(), 0
        for x in lines:
            if re.search(r"[^\x20\x09-\x0D]", x):
                dup += x in seen
                seen.add(x)
        grams = Counter(zip(w, w[1:], w[2:]))
        hit = {j + d for j, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for d in range(3)}
        expected[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), dup, len(hit), len(w) < 50 or 2 * len(hit) > len(w)] += 1
    got = quality.quality(docs)
    assert rowset(got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()) == expected
    assert got.where("kept and base_failed").count() == 0
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and rowset(r[:1] for r in kept.collect()) == rowset(r[:1] for r in got.where("kept").select("doc_id").collect())
    assert kept.count() > 20 and quality.quality(none).count() == 0


def test_a_rule_of_ones_own(docs):
    rules = (quality.Rule("short", "n_words", high=100),)
    assert {r.kept for r in quality.quality(docs, rules).where("not base_failed and n_words > 100").collect()} == {False}


# --- language-model scores -------------------------------------------------------------

@pytest.mark.parametrize("lane, shard, span", [(lm.LANE, lm.SHARD_BYTES, lm.RANGE_TOKENS), (7, 3000, 500)])
def test_lm(docs, none, monkeypatch, lane, shard, span):
    for n, v in (("LANE", lane), ("SHARD_BYTES", shard), ("RANGE_TOKENS", span)):
        monkeypatch.setattr(lm, n, v)
    got = lm.scores(docs).collect()
    toks = [(i, split(t) + [b""]) for i, t, *_ in ROWS]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in toks}
    c = Counter()  # of n-grams; None is the start of a text
    for i, w in toks:
        if not held[i]:
            for j in range(len(w)):
                whole = [None, *w[: j + 1]]
                for n in (1, 2, 3):
                    if len(whole) >= n + (n == 1):
                        c[tuple(whole[-n:])] += 1
            c[(None,)] += 1
    words = {g[0] for g in c if len(g) == 1} - {None}
    n, v, k = sum(c[x,] for x in words), len(words), lm.CONCENTRATION

    def p(w, *history):
        if not history:
            return (c[w,] + 0.5) / (n + 0.5 * (v + 1))
        return (c[(*history, w)] + k * p(w, *history[1:])) / (c[history] + k)

    expected = defaultdict(list)
    for i, w in toks:
        whole = [None, *w]
        score = sum(math.log10(p(x, *whole[max(0, j - 1) : j + 1])) for j, x in enumerate(w))
        expected[i].append((held[i], len(w), sum(c[x,] > 0 for x in w), n, sum(math.log10(p(x)) for x in w), score))
    assert len(got) == len(ROWS)
    for r in got:
        assert any(r[1:5] == e[:4] and r[5:] == pytest.approx(e[4:]) for e in expected[r.doc_id])
    for history in ((None,), (b"the",), (None, b"the"), (b"same", b"same")):  # a state's weights sum to one, with the unseen word
        assert sum(p(x, *history) for x in [*words, b"never"]) == pytest.approx(1)
    assert lm.scores(none).count() == 0


# --- tokens, shards, packing -----------------------------------------------------------

def plain_ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.default_path()).encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizers(monkeypatch):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.default_path())
    r = random.Random(4)
    bits = ["a", "b ", " ", "\n", "\t", "é", " ", "\x1c", "1", "!", "'s", " x", "  ", "ß", "中", "\r\n", "<|endoftext|>", "😀", "\xa0", "\u2003", "\u3000", "à"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(14))) for _ in range(3000)] + [t for _, t, *_ in ROWS]
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert any(50256 in x for x in want)  # the name of a special token is that token
    for block in (tokens.BLOCK_BYTES, 100):
        monkeypatch.setattr(tokens, "BLOCK_BYTES", block)
        ids, sizes = tokens.Encoder(tokens.default_path()).encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want
    assert tokens.Encoder(tokens.default_path()).encode(pa.array([], pa.string()))[1].tolist() == []


def test_packing(docs, none):
    want = Counter()
    for i, t, *_ in ROWS:
        ids = plain_ids(t) + [0]
        for s in range(0, len(ids), 1024):
            piece = ids[s : s + 1024]
            want[i, s, len(piece), zlib.crc32(struct.pack(f"<{len(piece)}I", *piece)), len(ids)] += 1
    got = packing.packed(docs).collect()
    assert rowset(r[:5] for r in got) == want
    used = defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.packed(none).count() == 0


def test_plan_uses_every_piece():
    r = random.Random(2)
    histogram = {size: r.randrange(1, 50) for size in r.sample(range(1, 1025), 300)}
    packs = packing.plan(dict(histogram))
    used = Counter()
    for count, sizes in packs:
        assert sum(sizes) <= 1024
        for s in sizes:
            used[s] += count
    assert used == Counter(histogram)
    total = sum(k * v for k, v in histogram.items())
    assert 1024 * sum(c for c, _ in packs) < 1.1 * total


def test_shards(docs, none, tmp_path):
    out = f"file://{tmp_path}/shards"
    size = 16 * 2 * 64
    got = shards.materialise(docs, out, seed=9, length=64, shard_bytes=size).collect()
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    slots = sorted({r.slot for r in got})
    assert slots == list(range(len(slots)))  # a permutation without gaps
    whole = shards.read_sequences(out, 0, 10**6, 64, size)
    assert len(whole) == len(slots)
    assert (shards.read_sequences(out, 20, 30, 64, size) == whole[20:50]).all()  # resumed across shards
    for i, t, *_ in ROWS[:57]:
        if sum(x[0] == i for x in ROWS) == 1:
            ids = []
            for r in sorted(pieces[i], key=lambda r: r.start):
                part = whole[r.slot][r.offset : r.offset + r.length]
                assert zlib.crc32(part.astype("<u4").tobytes()) == r.ids_crc32 and r.shard == r.slot // 16
                ids += part.tolist()
            assert ids == plain_ids(t) + [0]
    assert shards.materialise(none, f"file://{tmp_path}/none").count() == 0


def test_permutation():
    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(shards.permuted(np.arange(n), n, 5)) == list(range(n))
    assert (shards.permuted(np.arange(1000), 1000, 5) != shards.permuted(np.arange(1000), 1000, 6)).any()


# --- simhash ---------------------------------------------------------------------------

def fingerprint(text):
    w = split(text)
    grams = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(prints, tau):
    parent = {i: i for i in range(len(prints))}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= tau:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_simhash(docs, none):
    prints = [fingerprint(t) for _, t, *_ in ROWS]
    root = classes(prints, 3)
    low = {}
    for r, (i, *_) in zip(root, ROWS):
        low[r] = min(low.get(r, i), i)
    want = Counter((i, f"{p:016x}", low[r]) for (i, *_), p, r in zip(ROWS, prints, root))
    assert rowset(simhash.near_duplicates(docs).collect()) == want
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("tau, parts, rows", [(3, 4, 8192), (3, 4, 5), (7, 4, 8192), (3, 3, 8192)])
def test_links_of_crowded_prints(spark, monkeypatch, tau, parts, rows):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", rows)
    r = random.Random(tau)
    centres = [r.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << b for b in r.sample(range(64), r.randrange(0, 5))) for c in centres for _ in range(60)} | {r.getrandbits(64) for _ in range(100)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), tau, parts).collect()
    assert all(((g.a ^ g.b) & (1 << 64) - 1).bit_count() == g.d <= tau for g in got)
    parent = {p: p for p in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for g in got:
        parent[find(g.a)] = find(g.b)
    found = [find(p) for p in signed]
    want = classes([p & (1 << 64) - 1 for p in signed], tau)
    assert len(set(zip(found, want))) == len(set(found)) == len(set(want))


def test_one_of_each_group(docs, none):
    kept = simhash.keep_one(docs)
    ids = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == docs.columns
    assert ids[3] == 1 and ids[41] == ids[42] == 0 and ids[40] == 1 and ids[43] == 0  # copies, and a near copy of 40
    assert ids[5] == 1 and all(ids[i] == 1 for i in range(40) if i not in (7, 8))
    assert ids[7] == 2 and ids[8] == 0  # the repeated id holds the text of 8 and comes first
    assert simhash.keep_one(none).count() == 0


def test_copies_with_added_paragraphs(spark):
    """Five-word shingle sets of similarity 0.83: nine in ten are found although their words differ in more than scattered edits."""
    r, rows = np.random.default_rng(12), []
    for i in range(60):
        common, own = [f"c{x}" for x in r.integers(0, 300, 200)], [f"o{x}" for x in r.integers(0, 10**6, 300)]
        words = [x for pair in zip(own, common + common[:100]) for x in pair]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words + [f"n{x}" if x % 2 else f"c{x % 300}" for x in r.integers(0, 10**6, 100)]))]
    kept = {d.doc_id for d in simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"), prints=simhash.PRINTS).collect()}
    assert {2 * i for i in range(60)} <= kept
    assert sum(2 * i + 1 in kept for i in range(60)) <= 6


def test_rows_with_null_ids_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = [(None, text, 1, 77), (5, text, 2, 78), (4, text + " tail", 3, 79), (None, "other words " * 9, 4, 80), (None, None, 5, 81), (7, None, 6, 82), (7, None, 7, 82)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, th int, `key` int")
    got = sorted(tuple(r) for r in simhash.keep_one(docs).select("th", "key").collect())
    assert got[0] == (3, 79) and got[1] == (4, 80) and len(got) == 3 and got[2][1] == 82  # null ids give way to others


def test_near_copies_among_texts_of_one_fingerprint(spark):
    r, rows, gone = random.Random(8), [], set()
    for group in range(6):
        words = [f"g{group}w{i}" for i in range(300)]
        for i in range(8):
            if i < 7:
                r.shuffle(words)  # the same words, other shingles
            else:
                words[100], words[101] = words[101], words[100]  # a near copy of the text before
                gone.add(group * 10 + i)
            rows.append((group * 10 + i, " ".join(words)))
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {d.doc_id for d in kept.collect()} == {i for i, _ in rows} - gone


@pytest.mark.parametrize("rows", [8192, 2])
def test_links_are_verified_before_the_forest(spark, monkeypatch, rows):
    monkeypatch.setattr(simhash, "BUCKET_ROWS", rows)
    like, other = bytes([1] * 256), bytes([2] * 256)
    near = bytes([1] * 240 + [3] * 16)
    nodes = [(1, 0, like), (2, 0b111111, near), (3, 0b111, other), (4, ((1 << 40) - 1) << 20, bytes([9] * 256)), (5, ((1 << 40) - 1) << 20, like), (6, ((1 << 40) - 1) << 20, near)]
    nodes += [(10 + i, 1 << 20 | 1 << 50 | 0b11 << 30, bytes([20 + i] * 256)) for i in range(9)]
    got = simhash.similar(spark.createDataFrame(nodes, "node bigint, fp bigint, sketch binary"), 0.8).collect()
    pairs = {(min(g), max(g)) for g in got}
    assert {(1, 2), (5, 6)} <= pairs and all(x < 10 and y < 10 for x, y in pairs)
    assert not any({3, 4} & {*p} for p in pairs)


# --- passages --------------------------------------------------------------------------

def covered(text_words, often):
    out = set()
    for i in range(len(text_words) - 49):
        if often[tuple(text_words[i : i + 50])] > 1:
            out.update(range(i, i + 50))
    return len(out)


@pytest.mark.parametrize("crowd", [20_000, 1])
def test_repeated_passages(docs, none, crowd):
    all_ = [(i, split(t)) for i, t, *_ in ROWS]
    often = Counter(tuple(w[i : i + 50]) for _, w in all_ for i in range(len(w) - 49))
    want = Counter((i, len(w), covered(w, often)) for i, w in all_)
    assert rowset(suffixes.repeated_passages(docs, crowd=crowd).select("doc_id", "n_words", "n_repeated_words").collect()) == want
    assert suffixes.repeated_passages(none).count() == 0


def test_neighbours_find_every_passage():
    r = np.random.default_rng(9)
    side, size = suffixes.SIDE, suffixes.SIDE * 2
    for n in (1, 2, 40, 300):
        anchor = np.sort(r.integers(0, 4, n))
        sides = np.ascontiguousarray(r.integers(0, 2, (n, 1)) + (r.random((n, size)) < 0.04)).astype(np.uint32)
        lefts, rights = (r.integers(side - 8, side + 1, n) for _ in range(2))
        left, right = suffixes.common_passages(anchor, lefts, rights, sides)
        for i in range(n):
            both = [(side - k, k) for k in range(side + 1) for j in range(n) if j != i and anchor[i] == anchor[j] and min(rights[i], rights[j]) >= k and min(lefts[i], lefts[j]) >= side - k and (sides[i, k : k + side] == sides[j, k : k + side]).all()]
            assert (left[i], right[i]) == (max((x for x, _ in both), default=-1), max((y for _, y in both), default=-1))


def test_compact_windows_hold_every_run():
    r = np.random.default_rng(3)
    for n in (46, 60, 500):
        x = r.integers(0, 40, n).astype(np.uint64)  # with ties
        of = np.full(n - 45, -1)
        for c, first, last in zip(*windows.compact_windows(x, 46)):
            assert (of[first : last + 1] == -1).all()
            of[first : last + 1] = c
        assert all(x[of[i]] == x[i : i + 46].min() and i <= of[i] < i + 46 for i in range(n - 45))


def test_minimisers():
    r = np.random.default_rng(4)
    for n, w in ((10, 31), (31, 31), (400, 31), (400, 7)):
        x = r.integers(0, 50, n).astype(np.uint64)
        want = {i for s in range(n - w + 1) for i in range(s, s + w) if x[i] == x[s : s + w].min()}
        assert set(passages.minimisers(x, w).tolist()) == want


def test_near_passages(docs, none):
    got = windows.near_passages(docs).collect()
    assert rowset((r.doc_id, r.n_words) for r in got) == Counter((i, len(split(t))) for i, t, *_ in ROWS)
    by = {r.doc_id: r for r in got}
    assert all(by[i].n_near_words >= 60 for i in range(44, 48))  # the shared passage
    assert by[48].n_near_words >= 60  # with a changed word
    assert by[3].n_near_words == len(split(ROWS[3][1])) and by[41].n_near_words > 0
    lone = [i for i in range(40) if i not in (3, 5, 7, 8)]
    assert all(by[i].n_near_words == 0 for i in lone)
    assert windows.near_passages(none).count() == 0


def random_words(r, n):
    return [f"w{x}" for x in r.integers(0, 10**9, n)]


def test_one_variant_in_two_of_many_texts(spark):
    r = np.random.default_rng(5)
    rows, want = [], set()
    for group in range(8):
        passage = random_words(r, 60)
        for i in range(20):
            if i < 19:
                variant = list(passage)
                for j in r.choice(60, 8, replace=False):
                    variant[j] = f"edit{r.integers(10**9)}"
            if i >= 18:  # the last two hold the same one
                want.add(group * 100 + i)
            rows.append((group * 100 + i, " ".join(random_words(r, 40) + variant + random_words(r, 40))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {d.doc_id: d for d in windows.near_passages(docs).collect()}
    assert all(got[i].n_near_words >= 60 for i in want)
    cut = {d.doc_id: d.spans for d in windows.near_passages(docs, block=3).collect()}  # every two blocks meet
    assert cut == {i: d.spans for i, d in got.items()}


def test_verified_runs_against_all_pairs():
    r = np.random.default_rng(6)
    base = r.integers(0, 2**32, 52).astype(np.uint32)
    for texts in ((0, 0, 1, 2, 3, 4, 5), (0, 1, 1, 1, 2, 2, 2)):
        rows = []
        for _ in texts:
            x = base.copy()
            x[r.choice(52, 4, replace=False)] = r.integers(0, 2**32, 4)
            rows.append(x)
        th, zero = np.array(texts), np.zeros(len(texts), dtype=np.int64)
        m, at, _ = windows.verified(zero, zero - 1, th, th, zero, [x.tobytes() for x in rows])
        like = lambda i, j, s: len({*rows[i][s : s + 46]} & {*rows[j][s : s + 46]}) / len({*rows[i][s : s + 46]} | {*rows[j][s : s + 46]})
        assert sorted(zip(m, at)) == [(i, s) for i in range(len(th)) for s in range(7) if any(th[i] != th[j] and like(i, j, s) >= 0.8 for j in range(len(th)))]


@pytest.mark.parametrize("few", (2, windows.FEW))
def test_compared_runs_at_all_places_and_all_links(monkeypatch, few):
    monkeypatch.setattr(windows, "FEW", few)
    r = np.random.default_rng(11)
    for turn in range(12):
        base = r.integers(0, 2**32, 54).astype(np.uint32)
        rows, slot, anchor, texts = [], np.repeat([3, 4], [7, 3]), r.integers(0, 3, 10), np.array([0, 1, 2, 3, 0, 5, 6, 7, 8, 8])
        for _ in texts:
            x = base.copy()
            x[r.choice(54, r.integers(0, 6), replace=False)] = r.integers(0, 2**32)
            rows.append(np.insert(x, r.integers(0, 54), r.integers(0, 2**32, r.integers(0, 4) * (turn % 2)).astype(np.uint32)))
        high = texts.copy()
        high[2] = 20  # a class of several texts
        (m, at, o), bits = windows.compared(slot, np.full(10, -1), texts, high, anchor, [x.tobytes() for x in rows])
        runs = [[{*x[s : s + 46].tolist()} for s in range(len(x) - 45)] for x in rows]
        meets = lambda i, j: slot[i] == slot[j] and i != j and not texts[i] == high[i] == texts[j] == high[j]
        like = lambda a, b: len(a & b) / len(a | b) >= 0.8
        links = {(i, j) for i in range(10) for j in range(10) if meets(i, j) and any(like(a, b) for a in runs[i] for b in runs[j])}
        assert {(i, j) for i in range(10) for j, on in enumerate(np.unpackbits(bits[i]), 7 * (slot[i] == 4)) if on} == links and links
        want = [(i, s) for i in range(10) if i != 2 for s, a in enumerate(runs[i]) if any(like(a, b) for j in range(10) if meets(i, j) for b in runs[j])]
        assert sorted(zip(m.tolist(), at.tolist())) == want and all((i, j) in links for i, j in zip(m.tolist(), o.tolist()))


def test_a_large_group_is_compared_without_a_set_for_every_pair(monkeypatch):
    r = np.random.default_rng(14)
    rows = np.tile(r.integers(0, 2**32, 50).astype(np.uint32), (300, 1))
    for x in rows:
        at = r.choice(50, r.integers(1, 6), replace=False)
        x[at] = r.integers(0, 2**32, len(at))
    sets, distinct = [], windows.distinct
    monkeypatch.setattr(windows, "distinct", lambda x: sets.append(len(x)) or distinct(x))
    zero, text = np.zeros(300, dtype=np.int64), np.arange(300)
    (m, at, _), bits = windows.compared(zero, zero - 1, text, text, zero + 4, [x.tobytes() for x in rows])
    runs = [[{*x[s : s + 46].tolist()} for s in range(5)] for x in rows]
    like = np.array([[[len(a & b) / len(a | b) >= 0.8 for b in runs[j]] for a in runs[i]] for i in range(300) for j in range(i)])
    i, j = np.tril_indices(300, -1)
    linked, done = np.zeros((300, 300), dtype=bool), np.zeros((300, 5), dtype=bool)
    linked[i, j] = linked[j, i] = like.any(axis=(1, 2))
    np.logical_or.at(done, i, like.any(axis=2))
    np.logical_or.at(done, j, like.any(axis=1))
    assert (np.unpackbits(bits, axis=1, count=300).view(bool) == linked).all() and 0 < linked.sum() < 300 * 299
    assert sorted(zip(m.tolist(), at.tolist())) == list(zip(*(x.tolist() for x in np.nonzero(done))))
    assert sum(sets) < 300 * 299  # three for each pair of runs that is compared as sets


@pytest.mark.parametrize("few, one_by_one", ((2, 0), (2, 50), (2, 10**6), (200, 24)))
def test_shingles_twice_and_moved_places_in_a_group(monkeypatch, few, one_by_one):
    """Counts tell runs apart, also where members have a shingle twice or a word more: hardly any pair is compared as sets."""
    monkeypatch.setattr(windows, "FEW", few)
    monkeypatch.setattr(windows, "ONE_BY_ONE", one_by_one)
    monkeypatch.setattr(windows, "TILE", 32)
    r = np.random.default_rng(16)
    base, many = r.integers(0, 2**32, 52).astype(np.uint32), 90
    rows, anchor = [], np.zeros(many, dtype=np.int64)
    for i in range(many):
        x = base.copy()
        x[r.choice(52, r.integers(1, 6), replace=False)] = r.integers(0, 2**32)
        if i % 2:
            x[30:36], x[:2] = x[20:26], (0, 1)
        front = int(r.integers(0, 4))
        x = np.insert(x, [0] * front + [26] * int(r.integers(0, 3)), 7).astype(np.uint32)[: 56 - i % 5]
        rows.append(x)
        anchor[i] = front + 5
    sets, distinct = [], windows.distinct
    monkeypatch.setattr(windows, "distinct", lambda x: sets.append(len(x)) or distinct(x))
    zero, text = np.zeros(many, dtype=np.int64), np.arange(many)
    (m, at, o), bits = windows.compared(zero, zero - 1, text, text, anchor, [x.tobytes() for x in rows])
    runs = [[{*x[s : s + 46].tolist()} for s in range(len(x) - 45)] for x in rows]
    like = lambda a, b: len(a & b) / len(a | b) >= 0.8
    links = np.array([[i != j and any(like(a, b) for a in runs[i] for b in runs[j]) for j in range(many)] for i in range(many)])
    assert (np.unpackbits(bits, axis=1, count=many).view(bool) == links).all() and 0 < links.sum() < many * (many - 1)
    want = [(i, s) for i in range(many) for s, a in enumerate(runs[i]) if any(like(a, b) for j in np.flatnonzero(links[i]) for b in runs[j])]
    assert sorted(zip(m.tolist(), at.tolist())) == want and links[m, o].all()
    if one_by_one == 0:
        assert sum(sets) < many * many // 2  # less than one for each pair


def test_word_hashes():
    r = np.random.default_rng(15)
    words = [r.integers(0, 256, n, dtype=np.uint8).tobytes() for n in [*range(1, 80)] * 5]
    assert passages.word_hashes(words).tolist() == [xxhash.xxh64_intdigest(w, 42) for w in words] and len(passages.word_hashes([])) == 0


def test_links_of_all_texts_with_a_passage(spark):
    r = np.random.default_rng(12)
    rows, want = [], {}
    for g, (same, other) in enumerate([(3, 4), (0, 9), (9, 0), (1, 1), (2, 0), (40, 30)]):
        passage = random_words(r, 130)
        for i in range(same + other):
            variant = list(passage)
            if i >= same:  # a word of its own that leaves half of the passage as it is
                variant[r.integers(62, 68)] = f"edit{g}-{i}"
            rows.append((100 * g + i, " ".join(random_words(r, 30) + variant + random_words(r, 30))))
            want[100 * g + i] = (100 * g + i, same + other - 1)
    rows.append((990, rows[0][1]))  # a copy is the same text
    want[990] = want[0]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for block in (windows.BLOCK, 5):
        got = windows.near_passages(docs, block=block).collect()
        assert {d.doc_id: (d.class_id, d.n_links) for d in got} == want


def test_links_as_steps():
    r = np.random.default_rng(13)
    owner, num = r.integers(0, 5, 9000), r.integers(0, 3000, 9000) * 2**33
    name, links = windows._listed(owner, num)
    row, back = windows._numbers(links)
    assert list(zip(name[row].tolist(), back.tolist())) == sorted({*zip(owner.tolist(), num.tolist())})
    assert max(len(x) for x in links.to_pylist()) == windows.LINKS
    for size in (1, 4, 100):
        table = pa.table({"key": pa.array(name), "links": links})
        got = [d for b in windows._united(False)(table.to_batches(size)) for d in b.to_pylist()]
        assert [(d["key"], d["links"]) for d in got] == list(zip(name.tolist(), links.to_pylist()))
    assert len(windows._listed(owner[:0], num[:0])[0]) == 0


def test_spans_of_sorted_rows_in_batches():
    r = np.random.default_rng(8)
    for size in (1, 3, 1000):
        th, start, n, other = r.integers(-3, 3, 300), r.integers(0, 400, 300), r.integers(1, 12, 300), r.integers(0, 9, 300)
        order = np.lexsort((start, th))
        rows = pa.RecordBatch.from_arrays([pa.array(x[order]) for x in (th, start, start + n, other)], ["th", "start", "end", "other"])
        batches = [rows.slice(0, 0), *(rows.slice(i, size) for i in range(0, 300, size))]
        got = {d["th"]: d for b in windows._spans(batches) for d in b.to_pylist()}
        assert sorted(got) == sorted({*th.tolist()})
        for t, d in got.items():
            mine = th == t
            # places between words: touching spans are one
            inside = {2 * w + k for s, m in zip(start[mine].tolist(), n[mine].tolist()) for w in range(s, s + m) for k in (0, 1, 2)}
            ends = [(x // 2, next(y for y in range(x, 2000) if y + 1 not in inside) // 2) for x in sorted(inside) if x - 1 not in inside]
            assert d["spans"] == ";".join(f"{x}-{y}" for x, y in ends)
            assert d["covered"] == sum(y - x for x, y in ends) and d["n_links"] == len({*other[mine].tolist()})
    assert not list(windows._spans([]))


def test_runs_whose_signatures_are_far_apart_are_not_alike():
    r = np.random.default_rng(9)
    x = r.integers(0, 2**32, 46).astype(np.uint32)
    for changed in range(12):
        y = x.copy()
        y[r.choice(46, changed, replace=False)] = r.integers(0, 2**32, changed)
        apart = np.bitwise_count(windows.signatures(x) ^ windows.signatures(y)).sum()
        assert apart <= 2 * changed and (windows.jaccard(x[None], y[None])[0] < 0.8 or apart <= windows.APART)


def test_windows_of_several_texts():
    r = np.random.default_rng(10)
    for values in (2, 5, 10**6) * 20:
        n, run = int(r.integers(1, 200)), int(r.integers(1, 50))
        begin, x = np.unique(np.append(r.integers(0, n, 3), 0)), r.integers(0, values, n).astype(np.uint64)
        got = [(s, c) for c, first, last in zip(*windows.compact_windows(x, run, begin)) for s in range(first, last + 1)]
        want = [(s, s + int(np.argmin(x[s : s + run]))) for a, b in zip(begin, [*begin[1:], n]) for s in range(a, b - run + 1)]
        assert sorted(got) == want


def test_passages_of_just_over_fifty_words(spark):
    r = np.random.default_rng(7)
    rows, size = [], {}
    for g, n in enumerate([50, 51, 53, 55, 60] * 12):
        passage = random_words(r, n)
        for i in range(2):
            rows.append((2 * g + i, " ".join(random_words(r, 70) + passage + random_words(r, 70))))
            size[2 * g + i] = n
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert all(d.n_near_words >= size[d.doc_id] for d in windows.near_passages(docs).collect())


# --- decontamination -------------------------------------------------------------------

ITEMS = [(1, " ".join(ROWS[1][1].split()[5:30])), (2, "one"), (3, None), (4, "!!"), (5, ROWS[10][1]), (5, "meadow; RIDGE thermal"), (6, "absent words never seen here")]


def item_words(t):
    return [x for x in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]


@pytest.mark.parametrize("block", [8 << 20, 40])
def test_decontamination(spark, docs, none, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    phrases = defaultdict(set)
    for i, t in ITEMS:
        w = item_words(t)
        for j in range(max(1, len(w) - 9) if w else 0):
            phrases[tuple(w[j : j + 10])].add(str(i))
    want = Counter()
    import hashlib

    for i, t, *_ in ROWS:
        w, hit, items = item_words(t), set(), set()
        for p, names in phrases.items():
            for j in range(len(w) - len(p) + 1):
                if tuple(w[j : j + len(p)]) == p:
                    hit.update(range(j, j + len(p)))
                    items |= names
        want[i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)] += 1
    assert rowset(decontaminate.report(docs, bench).collect()) == want
    clean = decontaminate.cleaned(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    assert decontaminate.report(clean, bench.where("item_id = 1")).where("contaminated").count() == 0
    assert decontaminate.report(none, bench).count() == 0
    assert decontaminate.report(docs, bench.limit(0)).where("contaminated").count() == 0


def test_fm_index():
    r = np.random.default_rng(6)
    text = np.append(r.integers(1, 6, 700), 0)
    index = decontaminate.FMIndex(text)
    phrases = [text[i : i + n] for i, n in zip(r.integers(0, 690, 60), r.integers(1, 10, 60))] + [np.array([9, 2])]
    rows = np.zeros((len(phrases), 10), dtype=np.int64)
    for i, p in enumerate(phrases):
        rows[i, 10 - len(p) :] = p
    low, high = index.search(rows, np.array([len(p) for p in phrases]))
    for p, a, b in zip(phrases, low, high):
        assert sorted(index.locate(np.arange(a, b))) == [i for i in range(len(text) - len(p) + 1) if (text[i : i + len(p)] == p).all()]


# --- private data ----------------------------------------------------------------------

def luhn(s):
    total = 0
    for i, c in enumerate(reversed(re.sub(r"\D", "", s))):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(s):
    plain = re.sub(" ", "", s)
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def test_pii(spark):
    found = ["4111111111111111", "4111 1111 1111 1111", "10.0.0.1", "+1 (617) 555-7713", "1984-02-29", "31.12.1999", "Über.34@mail7.example.com", "9b0b3c6a43eb78aa99cbd7049c572391524f37a8", "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"]
    kept = ["4111111111111112", "2023-02-30", "1.2.3", "999.1.1.1", "1500-01-01", "12345", "a@b", "v1.2.3.4.5", "DE88 3704 0044 0532 0130 00", "+0 170 1234567", "GB82"]
    rows = [(i, f"see {x}, {y} or {x}.", "x") for i, (x, y) in enumerate(zip(found, kept))] + [(98, None, "x"), (99, "", None), (99, "no number", "x")]
    spelled = ["+491701234567", "+49 170 1234567", "+49-170-123-4567", "+49 (170) 123 4567"]
    rows += [(200 + i, x, "x") for i, x in enumerate(spelled)] + [(300, f"mark \ue000 {found[0]} and \ue001 {found[3]}", "x"), (301, " ".join(found) * 400, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __found string")
    got = [(r.doc_id, r.text, r.n) for r in pii.pseudonymised(df, "k", count="n").collect()]
    assert {(98, None, 0), (99, "", 0), (99, "no number", 0)} <= set(got)
    by, n = {i: t for i, t, _ in got}, {i: n for i, _, n in got}
    new = {}
    for i, (x, y) in enumerate(zip(found, kept)):
        a, b, c = re.fullmatch(r"see (.+), (.+) or (.+)\.", by[i]).groups()
        assert a == c != x and b == y and n[i] == 2
        new[x] = a
        if "@" not in x:
            shape = lambda s: re.sub("[0-9a-f]", "9", s) if i == 7 else re.sub(r"\d+" if i == 2 else r"\d", "9", s)
            assert shape(a) == shape(x)
    assert luhn(new[found[0]]) and re.sub(" ", "", new[found[1]]) == new[found[0]]
    assert re.sub(" ", "", new[found[8]]) == new[found[9]] and all(mod97(new[x]) == 1 for x in found[8:])
    phones = {re.sub(r"\D", "", by[200 + i]) for i in range(4)}  # one pseudonym, in each spelling
    assert len(phones) == 1 and phones != {"491701234567"} and all(re.sub(r"\d", "9", by[200 + i]) == re.sub(r"\d", "9", x) for i, x in enumerate(spelled))
    assert by[300] == f"mark \ue000 {new[found[0]]} and \ue001 {new[found[3]]}" and n[300] == 2
    assert n[301] > 400 * 8  # a very long text
    other = pii.pseudonymised(df, key="other").where("doc_id = 0").first().text
    assert other != by[0]
    assert pii.pseudonymised(df.limit(0), "k").count() == 0


def test_the_network_against_a_plain_one(spark):
    """feistel() in plain Python, for digits, phones and days."""
    import hashlib

    def network(x, y, a, b, kind):
        for i in range(pii.ROUNDS):
            mixed = int(hashlib.sha256(f"k|{kind}|{i}|{y}".encode()).hexdigest()[:12], 16)
            x, y = y, (x + mixed) % (a if i % 2 == 0 else b)
        return x, y

    phones = ["+491701234567", "+14155550100", "+3312345678"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in phones], "p string").select(pii.pseudonym(F.col("p"), "k")).collect()]
    for p, g in zip(phones, got):
        d = p[1:]
        h = len(d) // 2
        x, y = network(int(d[:h]) - 10 ** (h - 1), int(d[h:]), 9 * 10 ** (h - 1), 10 ** (len(d) - h), "phone")
        assert g == f"+{x + 10 ** (h - 1)}{y:0{len(d) - h}d}"
    x, y = network(12, 345, 100, 1000, "t")
    assert spark.createDataFrame([("12345",)], "d string").select(pii.permuted_digits(F.col("d"), "k", "t")).first()[0] == f"{x:02d}{y:03d}"


def test_pseudonyms_are_a_permutation(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"))
    assert df.select(pii.permuted_digits(F.col("d"), "k", "t").alias("p")).distinct().count() == 1000
    days = spark.range(0, 146097, 97).select(F.date_format(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("d"))
    assert days.select(pii.pseudonym(F.col("d"), "k").alias("p")).distinct().count() == days.count()


# --- URL filters -----------------------------------------------------------------------

def test_urls(spark):
    pages = [(1, "https://User@A.B.example.COM:80/x/y?q#f", 5), (2, "http://other.org", 5), (3, None, 5), (4, "  ", 5), (5, "b.example.com/x/z", 20), (1, "https://a.b.example.com/x/y", 5), (6, "http://b.example.com", None)]
    entries = [("spam", "example.com", "add", 1), ("spam", "example.com", "remove", 10), ("bad", "a.b.example.com/x", "add", 5), ("late", "b.example.com", "add", 6), ("same", "other.org", "add", 3), ("same", "other.org", "remove", 3), (None, "other.org", "add", 1), ("spam", None, "add", 1), ("spam", "com", "add", 1), ("again", "b.example.com/x/z", "add", 1), ("again", "b.example.com/x/z", "add", 9)]
    got = urls.judged(spark.createDataFrame(pages, "page_id long, url string, day int"), spark.createDataFrame(entries, "list_name string, value string, action string, day int"))
    assert rowset(got.select("page_id", "host", "lists", "blocked").collect()) == Counter(
        {(1, "a.b.example.com", "bad,spam", True): 2, (2, "other.org", "", False): 1, (3, None, "", False): 1, (4, None, "", False): 1, (5, "b.example.com", "again,late", True): 1, (6, "b.example.com", "", False): 1}
    )
    assert urls.judged(spark.createDataFrame([], "page_id long, url string, day int"), spark.createDataFrame(entries, "list_name string, value string, action string, day int")).count() == 0
