"""Repeated passages by a sparse suffix array.

Of all suffixes of all texts only those are kept that start at a minimiser: the least hash of
``LENGTH - ANCHOR + 1`` runs of ``ANCHOR`` words. Every passage of ``LENGTH`` words holds one, and
equal passages hold the same one. Suffixes are sorted by their first words; those whose first
``ANCHOR`` words occur once in the corpus leave before any text moves. The others are sorted on by
the words after the anchor, and backwards by the words before it; neighbours are compared word by
word to the right and extended to the left, so a passage is found if and only if it occurs at two
places. Longer passages hold an anchor for each ``SIDE + 1`` of their words, and their parts are
joined. Equal texts are one unit, so copies cost nothing. One word said over and
over would make every place a minimiser: inside such a run only its first place is kept, and a
run of more than ``LENGTH`` words repeats itself. ``CROWD`` bounds what a task holds of one anchor;
one with more suffixes is resolved by counting its passages in a grouped aggregation, with the
same result.

Words are compared by 64-bit hashes (32 bits for each word beside the anchor).

Defined edge cases: null and short texts have no passage; a text that occurs twice (also as
a repeated row) is one passage if it has ``LENGTH`` words; null keys are kept and their texts
compared as any others; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.llm.passages import gram_hashes, minimisers, mixed, word_hashes, words_of
from siteweave.plans.store import written

LENGTH = 50
ANCHOR = 20
SIDE = LENGTH - ANCHOR
CROWD = 200_000
#: Rows of a passage that are no longer brought together, and such passages at most (8 bytes each are sent to every task).
HOT, HOT_NAMES = 50_000, 100_000


def kept_places(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the kept suffixes, (start, end) of runs of one word that repeat themselves)."""
    same = grams[1:] == grams[:-1]
    run = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    begin = run & ~np.concatenate([[False], same])
    at = minimisers(np.where(run, np.uint64(2**64 - 1), grams), SIDE + 1)
    at = at[~run[at] | begin[at]]
    first = np.flatnonzero(begin)
    end = np.flatnonzero(run & ~np.concatenate([same, [False]])) + ANCHOR
    own = end - first > LENGTH
    return at, np.stack([first[own], end[own]], axis=1)


def _anchors(docs: DataFrame, key: str) -> DataFrame:
    """A row (key, n_words, text hash, -1) for each document, (null, anchor hash, text hash, place) for each anchor and
    (null, end, text hash, -2 - start) for each run of one word that repeats itself."""

    def run(batches):
        for b in batches:
            ids, ths = b.column(0), b.column(1).to_numpy()
            sizes, anchors, owners, places = [], [], [], []
            for th, t in zip(ths, b.column(2).cast(pa.binary())):
                words = words_of(t.as_py())
                sizes.append(len(words))
                if len(words) >= LENGTH:
                    grams = gram_hashes(word_hashes(words), ANCHOR)
                    at, runs = kept_places(grams)
                    anchors += [grams[at].view(np.int64), runs[:, 1]]
                    owners.append(np.full(len(at) + len(runs), th))
                    places += [at.astype(np.int32), (-2 - runs[:, 0]).astype(np.int32)]
            yield pa.RecordBatch.from_arrays([ids, pa.array(sizes, pa.int64()), pa.array(ths), pa.array(np.full(len(ths), -1, dtype=np.int32))], names)
            if anchors:
                a, o, p = map(np.concatenate, (anchors, owners, places))
                yield pa.RecordBatch.from_arrays([pa.nulls(len(a), ids.type), pa.array(a), pa.array(o), pa.array(p)], names)

    names = [key, "anchor", "th", "place"]
    return docs.mapInArrow(run, f"`{key}` {docs.schema[key].dataType.simpleString()}, anchor bigint, th bigint, place int")


def _suffixes(texts: DataFrame) -> DataFrame:
    """texts (th, text, places) -> anchor, th, place, lefts, rights: how many words there are, and sides: their hashes."""

    def run(batches):
        for b in batches:
            out = []
            for th, t, places in zip(b.column(0).to_numpy(), b.column(1).cast(pa.binary()), b.column(2)):
                hashes = word_hashes(words_of(t.as_py()))
                at = np.sort(np.asarray(places.values, dtype=np.int64))
                short = np.concatenate([np.zeros(SIDE, dtype=np.uint32), (hashes >> np.uint64(32)).astype(np.uint32), np.zeros(SIDE, dtype=np.uint32)])
                around = np.concatenate([np.arange(SIDE), np.arange(SIDE + ANCHOR, 2 * SIDE + ANCHOR)])
                sides = short[at[:, None] + around[None, :]]
                out.append((gram_hashes(hashes, ANCHOR)[at].view(np.int64), np.full(len(at), th), at, np.minimum(at, SIDE), np.minimum(len(hashes) - ANCHOR - at, SIDE), sides))
            if out:
                a, o, p, lefts, rights, sides = (np.concatenate(c) for c in zip(*out))
                for i in range(0, len(a), 20_000):
                    j = slice(i, i + 20_000)
                    flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(8 * SIDE), len(a[j]), [None, pa.py_buffer(sides[j].tobytes())]).cast(pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(a[j]), pa.array(o[j]), pa.array(p[j].astype(np.int32)), pa.array(lefts[j].astype(np.int8)), pa.array(rights[j].astype(np.int8)), flat], names)

    names = ["anchor", "th", "place", "lefts", "rights", "sides"]
    return texts.mapInArrow(run, "anchor bigint, th bigint, place int, lefts tinyint, rights tinyint, sides binary")


def _side_hashes(sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the nearest 0 .. SIDE words on the left and on the right of each row."""
    both = []
    for columns in (range(SIDE - 1, -1, -1), range(SIDE, 2 * SIDE)):
        now = [np.full(len(sides), 7, dtype=np.uint64)]
        for c in columns:
            now.append(mixed(now[-1] * np.uint64(0x9E3779B97F4A7C15) + sides[:, c]))
        both.append(np.stack(now))
    return both[0], both[1]


def _passage_hashes(anchor: np.ndarray, lefts, rights, sides):
    """For each split: the rows that have such a passage, and its hash."""
    left, right = _side_hashes(sides)
    name = mixed(anchor.view(np.uint64))
    for on_right in range(SIDE + 1):
        rows = np.flatnonzero((lefts >= SIDE - on_right) & (rights >= on_right))
        yield on_right, rows, mixed(left[SIDE - on_right, rows] * np.uint64(3) ^ right[on_right, rows] + name[rows])


def _columns(b) -> tuple:
    anchor, th, place, lefts, rights = (b.column(i).to_numpy() for i in range(5))
    sides = np.frombuffer(b"".join(b.column(5).to_pylist()), dtype=np.uint32).reshape(-1, 2 * SIDE)
    return anchor, th, place.astype(np.int64), lefts, rights, sides


def ranked(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of rows of numbers, how many numbers each has in common with the row before it in this order)."""
    whole = np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").ravel()
    order = np.argsort(whole, kind="stable")
    equal = rows[order][1:] == rows[order][:-1]
    return order, np.concatenate([[0], np.where(equal.all(axis=1), rows.shape[1], equal.argmin(axis=1))])[: len(rows)]


def common_passages(anchor: np.ndarray, lefts: np.ndarray, rights: np.ndarray, sides: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix the most words on the left and on the right of its anchor that a passage of LENGTH words which
    occurs again takes; -1 if there is none.

    The suffixes are sorted once by what follows the anchor and once by what precedes it, read backwards. Suffixes
    with r words in common are an interval of the first order; inside it neighbours of the second order have
    the longest extension to the left, so comparing neighbours finds every passage."""
    n = len(anchor)
    left, right = sides[:, SIDE - 1 :: -1], sides[:, SIDE:]
    name = np.unique(anchor, return_inverse=True)[1]
    order, common = ranked(np.concatenate([name[:, None].astype(np.uint32), right], axis=1))
    back, _ = ranked(left)
    rank = np.empty(n, dtype=np.int64)
    rank[back] = np.arange(n)
    most_left, most_right = np.full(n, -1), np.full(n, -1)
    part = np.empty(n, dtype=np.int64)
    for r in range(SIDE + 1):
        part[order] = np.cumsum(common < r + 1)  # one class for each anchor and r words after it
        able = np.flatnonzero((rights >= r) & (lefts >= SIDE - r))
        by = able[np.argsort(part[able] * n + rank[able], kind="stable")]
        x, y = by[:-1], by[1:]
        near = part[x] == part[y]
        x, y = x[near], y[near]
        again = (left[x, : SIDE - r] == left[y, : SIDE - r]).all(axis=1)
        hit = np.concatenate([x[again], y[again]])
        most_left[hit] = np.maximum(most_left[hit], SIDE - r)
        most_right[hit] = np.maximum(most_right[hit], r)
    return most_left, most_right


def _neighbours(batches):
    """Batches sorted by anchor -> th, start, end: what each suffix has in common with another one."""
    waiting = None

    def spans(rows):
        anchor, th, place, lefts, rights, sides = rows
        left, right = common_passages(anchor, lefts, rights, sides)
        hit = np.flatnonzero(right >= 0)
        return pa.RecordBatch.from_arrays([pa.array(th[hit]), pa.array(place[hit] - left[hit]), pa.array(place[hit] + ANCHOR + right[hit])], ["th", "start", "end"])

    for b in batches:
        rows = _columns(b)
        if waiting is not None:
            rows = tuple(np.concatenate(x) for x in zip(waiting, rows))
        if not len(rows[0]):
            continue
        whole = int(np.searchsorted(rows[0], rows[0][-1]))  # the last anchor may go on
        if whole:
            yield spans([x[:whole] for x in rows])
        waiting = tuple(x[whole:] for x in rows)
    if waiting is not None and len(waiting[0]):
        yield spans(waiting)


def _counted(batches):
    """Every passage of every suffix: name, th, start."""
    for b in batches:
        anchor, th, place, lefts, rights, sides = _columns(b)
        for on_right, at, name in _passage_hashes(anchor, lefts, rights, sides):
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64)), pa.array(th[at]), pa.array(place[at] - (SIDE - on_right))], ["name", "th", "start"])


def merged(spans):
    """array<struct<start, end>> sorted and joined where they touch."""
    kind = "array<struct<start: bigint, end: bigint>>"

    def add(out, s):
        last = F.element_at(out, -1)
        longer = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
        return F.when((F.size(out) > 0) & (s["start"] <= F.get(out, F.size(out) - 1)["end"]), longer).otherwise(F.concat(out, F.array(s)))

    return F.aggregate(F.sort_array(spans), F.array().cast(kind), add)


def repeated_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """key, n_words, n_repeated_words, n_spans, spans ("start-end" by words, ;-joined): what occurs at two places or more."""
    base = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"), F.col(text).alias("__text"))
    rows = written(_anchors(base, key), "anchors")
    each, anchors = rows.where("place = -1"), rows.where("place >= 0").select("anchor", "th", "place")
    units = each.groupBy("th").agg(F.min(key).alias("rep"), F.count("*").alias("copies"), F.first("anchor").alias("n_words"))
    often = anchors.groupBy("anchor").agg(F.min("th").alias("a"), F.max("th").alias("b"), F.min("place").alias("c"), F.max("place").alias("d"), F.count("*").alias("n"))
    often = written(often.where("a <> b or c <> d").select("anchor", "n"), "often")
    found = anchors.join(often.select("anchor"), "anchor").select("th", "place").groupBy("th").agg(F.collect_set("place").alias("places"))
    wanted = found.join(units.select("th", "rep"), "th").select(F.col("th").alias("__th"), "rep", "places")
    texts = base.join(wanted.hint("shuffle_hash"), base[key].eqNullSafe(F.col("rep")) & (F.col("th") == F.col("__th"))).select("th", "__text", "places")
    suffixes = _suffixes(texts)
    crowded = often.where(F.col("n") > crowd).select("anchor")  # by copies too, so more than enough
    schema = "th bigint, start bigint, end bigint"
    if crowded.isEmpty():
        near = suffixes.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_neighbours, schema)
    else:
        suffixes = written(suffixes, "suffixes")
        few = suffixes.join(crowded, "anchor", "left_anti").select(suffixes.columns)
        near = few.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_neighbours, schema)
        all_ = written(suffixes.join(crowded, "anchor", "left_semi").select(suffixes.columns).mapInArrow(_counted, "name bigint, th bigint, start bigint"), "crowded")
        twice = written(all_.groupBy("name").agg(F.count("*").alias("n")).where("n > 1"), "twice")
        # names that fill a task are few: the threshold bounds them, so they are sent to the rows
        least = max(HOT, -(-all_.count() // HOT_NAMES))
        hot = F.broadcast(twice.where(F.col("n") >= least).select("name"))  # HOT_NAMES at most
        many = all_.join(hot, "name", "left_semi")
        some = all_.join(hot, "name", "left_anti").join(twice.where(F.col("n") < least).select("name"), "name")
        for rows_ in (many, some):
            near = near.union(rows_.select("th", "start", (F.col("start") + LENGTH).alias("end")))
    near = near.union(rows.where("place < -1").select("th", F.expr("cast(-2 - place as bigint)"), "anchor").distinct())
    spans = near.groupBy("th").agg(F.collect_set(F.struct("start", "end")).alias("spans")).select("th", merged(F.col("spans")).alias("spans"))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end")))
    per_text = units.join(spans, "th", "left").select("th", F.when((F.col("copies") > 1) & (F.col("n_words") >= LENGTH), whole).otherwise(F.coalesce("spans", F.array().cast("array<struct<start: bigint, end: bigint>>"))).alias("spans"))
    done = each.select(key, F.col("anchor").alias("n_words"), "th").join(per_text, "th")
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ";")
    return done.select(key, "n_words", covered.alias("n_repeated_words"), F.size("spans").cast("long").alias("n_spans"), listed.alias("spans"))
