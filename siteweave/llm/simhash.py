"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are made once and equal ones collapse. Their 64 bits are put into ``parts``
groups of correlated bits. If two fingerprints differ in at most ``tau`` bits and the
thresholds t_i of the groups satisfy sum(t_i + 1) = tau + 1, then in one group at least
they differ in at most t_i bits. For each fingerprint a dynamic programme takes the
thresholds with the fewest expected candidates (-1 skips a group, so crowded values are
avoided). Index and probe rows meet by bucket, are verified on all 64 bits, and only a
minimum spanning forest of the links leaves a task: the output is linear in the input,
however dense a group of copies is.

Defined edge cases: null and wordless texts have the fingerprint zero, linked like any
other; shorter texts than a shingle are one shingle; repeated rows and ids stay repeated;
columns besides key and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.operators.components import components
from siteweave.plans.store import written

BITS = 64
#: Index rows of a bucket that one task holds at once; a fuller bucket is split.
BUCKET_ROWS = 8192
#: Candidate pairs that a task verifies at once.
PAIR_BLOCK = 1 << 18
#: What sending one probe row costs, in verified candidates.
PROBE_COST = 8
MAX_RADIUS = 2


def majority(hashes: np.ndarray) -> int:
    """64 bits, each set if it is set in over half of the hashes; as a signed number."""
    total = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes)).view(">i8")[0]) if len(hashes) else 0


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64, seed 42, of each run of ``size`` words, joined by one space; repeats count."""
    if len(words) < size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), 42)] if words else [], dtype=np.uint64)
    runs = zip(*(words[i:] for i in range(size)))
    return np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(42)), dtype=np.uint64, count=len(words) - size + 1)


def fingerprints(docs: DataFrame, shingle: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fp: a row for each document."""

    def run(batches):
        for b in batches:
            bodies = b.column(1).cast(pa.binary())
            fps = [majority(shingle_hashes((t.as_py() or b"").lower().split(), shingle)) for t in bodies]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], [key, "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, fp bigint")


# --- the index -------------------------------------------------------------------------

def bit_groups(fps: DataFrame, parts: int) -> list[list[int]]:
    """Groups of correlated bits, from the joint counts of all fingerprints (64 x 64 numbers)."""

    def run(batches):
        both, ones, n = np.zeros((BITS, BITS)), np.zeros(BITS), 0
        for b in batches:
            bits = bits_of(b.column(0).to_numpy()).astype(np.float64)
            both, ones, n = both + bits.T @ bits, ones + bits.sum(axis=0), n + len(bits)
        if n:
            counts = np.concatenate([both.ravel(), ones, [n]]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(counts))), pa.array(counts)], ["i", "n"])

    got = fps.select("fp").mapInArrow(run, "i bigint, n bigint").groupBy("i").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + BITS + 1)
    for i, n in got:
        flat[i] = n
    total = max(flat[-1], 1.0)
    mean = flat[BITS * BITS : -1] / total
    cov = flat[: BITS * BITS].reshape(BITS, BITS) / total - np.outer(mean, mean)
    spread = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    alike = np.abs(cov / np.outer(spread, spread))
    free, groups = set(range(BITS)), []
    for g in range(parts):
        width = len(free) // (parts - g)
        group = [max(sorted(free), key=lambda i: alike[i, sorted(free)].sum())]
        free.discard(group[0])
        while len(group) < width:
            group.append(max(sorted(free), key=lambda i: alike[i, group].sum()))
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


def bits_of(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype(">i8").view(np.uint8).reshape(-1, 8), axis=1)


def values_of(fps: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """Each fingerprint's number in each group of bits."""
    bits = bits_of(fps)
    return np.stack([bits[:, g].astype(np.int64) @ (1 << np.arange(len(g), dtype=np.int64)) for g in groups], axis=1)


def balls(width: int, radius: int) -> np.ndarray:
    """The numbers of at most ``radius`` set bits."""
    n = np.arange(1 << width)
    return n[np.bitwise_count(n) <= radius]


def histogram(fps: DataFrame, groups: list[list[int]]) -> list[np.ndarray]:
    """How many fingerprints have each value of each group; 2^width numbers a group at most."""

    def run(batches):
        tally = [np.zeros(1 << len(g), dtype=np.int64) for g in groups]
        for b in batches:
            values = values_of(b.column(0).to_numpy(), groups)
            for g, t in enumerate(tally):
                np.add.at(t, values[:, g], 1)
        for g, t in enumerate(tally):
            at = np.flatnonzero(t)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g)), pa.array(at), pa.array(t[at])], ["g", "v", "n"])

    found = fps.select("fp").mapInArrow(run, "g bigint, v bigint, n bigint").groupBy("g", "v").agg(F.sum("n").alias("n")).toPandas()
    out = [np.zeros(1 << len(g), dtype=np.int64) for g in groups]
    for g, t in enumerate(out):
        own = found[found.g == g]
        t[own.v.to_numpy(dtype=np.int64)] = own.n.to_numpy(dtype=np.int64)
    return out


def expected(counts: list[np.ndarray], groups: list[list[int]]) -> list[np.ndarray]:
    """For each group, threshold and value: candidates within it, and what its probes cost."""
    out = []
    for t, g in zip(counts, groups):
        near = [np.zeros(len(t))]  # threshold -1
        at = np.arange(len(t))
        for r in range(MAX_RADIUS + 1):
            masks = balls(len(g), r)
            found = sum(t[at ^ m] for m in masks) if r < 2 else sum(near[2][at ^ m] - PROBE_COST * (len(g) + 1) for m in balls(len(g), 1)) / 2
            near.append(found + PROBE_COST * float(len(masks)))
        out.append(np.stack(near).astype(np.float32))
    return out


def allocate(values: np.ndarray, cost: list[np.ndarray], tau: int) -> np.ndarray:
    """Thresholds (-1 and up) for each fingerprint and group with the least expected cost."""
    n, parts = values.shape
    best = np.full((tau + 2, n), np.inf, dtype=np.float32)
    best[0] = 0
    choice = np.zeros((parts, tau + 2, n), dtype=np.int8)
    for g in range(parts):
        own = cost[g][:, values[:, g]]
        after = np.full_like(best, np.inf)
        for took in range(min(MAX_RADIUS + 2, tau + 2)):
            for total in range(took, tau + 2):
                new = best[total - took] + own[took]
                better = new < after[total]
                after[total][better] = new[better]
                choice[g, total][better] = took
        best = after
    out = np.zeros((n, parts), dtype=np.int64)
    left, at = np.full(n, tau + 1), np.arange(n)
    for g in range(parts - 1, -1, -1):
        took = choice[g, left, at]
        out[:, g], left = took - 1, left - took
    return out


def bucket_rows(fps: DataFrame, tau: int, groups, counts, cost) -> DataFrame:
    """Index rows (probe 0) and probe rows (probe 1) by bucket; a full bucket has several slots."""
    base = np.concatenate([[0], np.cumsum([1 << len(g) for g in groups])])
    slots = np.maximum(1, -(-np.concatenate(counts) // BUCKET_ROWS))
    start = np.concatenate([[0], np.cumsum(slots)])
    shared = fps.sparkSession.sparkContext.broadcast((base, slots, start, cost))  # 2^width numbers a group

    def run(batches):
        base, slots, start, cost = shared.value
        for b in batches:
            fp = b.column(0).to_numpy()
            values = values_of(fp, groups)
            spread = fp.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            thresholds = allocate(values, cost, tau)
            for g in range(len(groups)):
                bucket = base[g] + values[:, g]
                yield rows(start[bucket] + (spread % slots[bucket].astype(np.uint64)).astype(np.int64), fp, 0)
                for r in range(MAX_RADIUS + 1):
                    own = np.flatnonzero(thresholds[:, g] == r)
                    masks = balls(len(groups[g]), r)
                    for i in range(0, len(own), max(1, 100_000 // len(masks))):
                        part = own[i : i + max(1, 100_000 // len(masks))]
                        near = base[g] + (values[part, g][:, None] ^ masks[None, :]).ravel()
                        who = np.repeat(fp[part], len(masks))
                        full = np.concatenate(counts_of(near))
                        near, who = near[full], who[full]
                        times = slots[near]
                        first = np.repeat(np.cumsum(times) - times, times)
                        yield rows(np.repeat(start[near], times) + np.arange(len(first)) - first, np.repeat(who, times), 1)

    present = fps.sparkSession.sparkContext.broadcast(np.packbits(np.concatenate(counts) > 0))

    def counts_of(near):
        return [np.flatnonzero(present.value[near >> 3] & (128 >> (near & 7)))]

    def rows(slot, fp, probe):
        return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(fp), pa.array(np.full(len(fp), probe, dtype=np.int8))], ["slot", "fp", "probe"])

    return fps.select("fp").mapInArrow(run, "slot bigint, fp bigint, probe tinyint")


def spanning(a: np.ndarray, b: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Places of the edges of a minimum spanning forest, by rounds in which each tree takes its shortest edge."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label, order, taken = np.arange(len(nodes)), np.lexsort((b, a, d)), []
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    alive = np.arange(len(a))
    while True:
        la, lb = label[a[alive]], label[b[alive]]
        apart = la != lb
        alive, la, lb = alive[apart], la[apart], lb[apart]
        if not len(alive):
            return np.unique(np.concatenate(taken)) if taken else np.zeros(0, dtype=np.int64)
        best = np.full(len(nodes), len(order))
        np.minimum.at(best, la, rank[alive])
        np.minimum.at(best, lb, rank[alive])
        new = order[np.unique(best[best < len(order)])]
        taken.append(new)
        while True:
            low = np.minimum(label[a[new]], label[b[new]])
            before = label.copy()
            np.minimum.at(label, before[a[new]], low)
            np.minimum.at(label, before[b[new]], low)
            label = label[label]
            label = label[label]
            if (label == before).all():
                break


def links(fps: DataFrame, tau: int = 3, parts: int = 4) -> DataFrame:
    """fps (fp), distinct -> (a, b, d): a spanning forest of all pairs within tau bits, a <= b."""
    if (MAX_RADIUS + 1) * parts < tau + 1:
        raise ValueError("too few parts for this distance")
    groups = bit_groups(fps, parts)
    counts = histogram(fps, groups)
    rows = bucket_rows(fps, tau, groups, counts, expected(counts, groups))

    def run(batches):
        slot0, fp0 = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for b in batches:
            slot, fp, probe = (c.to_numpy() for c in b.columns)
            own = probe == 0
            slots, known = np.concatenate([slot0, slot[own]]), np.concatenate([fp0, fp[own]])
            ps, pf = slot[~own], fp[~own]
            low, high = np.searchsorted(slots, ps, "left"), np.searchsorted(slots, ps, "right")
            total = np.cumsum(high - low)
            cut = 0
            while cut < len(ps):
                end = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + PAIR_BLOCK, "right")))
                lo, n = low[cut:end], (high - low)[cut:end]
                first = np.repeat(np.cumsum(n) - n, n)
                left, right = np.repeat(pf[cut:end], n), known[np.repeat(lo, n) + np.arange(len(first)) - first]
                d = np.bitwise_count((left ^ right).view(np.uint64)).astype(np.int8)  # of a signed number it would count the absolute value's
                near = (d <= tau) & (left != right)
                if near.any():
                    x, y, d = np.minimum(left[near], right[near]), np.maximum(left[near], right[near]), d[near]
                    keep = spanning(x, y, d)
                    yield pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(y[keep]), pa.array(d[keep])], ["a", "b", "d"])
                cut = end
            if len(slot):
                last = slots == slot[-1]
                slot0, fp0 = slots[last], known[last]

    met = rows.repartition("slot").sortWithinPartitions("slot", "probe")
    return met.mapInArrow(run, "a bigint, b bigint, d tinyint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, tau: int = 3, parts: int = 4, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fingerprint (16 hex digits), component_id (the smallest key reachable over links)."""
    prints = written(fingerprints(docs, shingle, key, text), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min(key).alias("low")), "nodes")
    roots = components(links(nodes, tau, parts))
    member = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    named = member.join(lowest, "root").select(F.col("fp").alias("__fp"), "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, F.col("fp") == F.col("__fp")).select(key, hexed.alias("fingerprint"), "component_id")


# --- near copies of whole documents ----------------------------------------------------

#: Bins of a sketch: a document's smallest five-word shingle hash in each, one byte of it.
SKETCH = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)


#: Fingerprints of a document's words, each with other hashes: two documents are candidates if any of them is near.
PRINTS = 3


def word_print(words: list[bytes], size: int, prints: int = PRINTS) -> tuple[list[int], bytes]:
    """Fingerprints of the set of words, and the sketch of the set of ``size``-word shingles.

    A sketch holds 0 for an empty bin. Its agreement is an estimate of the sets' Jaccard
    similarity (standard error 0.025 at 0.8 for long texts, less for short ones).
    """
    known = list(dict.fromkeys(words))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, known, repeat(42)), dtype=np.uint64, count=len(known))
    number = dict(zip(known, range(len(known))))
    each = hashes[np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))]
    runs = np.zeros(max(1, len(each) - size + 1) if len(each) else 0, dtype=np.uint64)
    for i in range(min(size, len(each))):
        part = each[i : i + len(runs)] if len(each) >= size else each[i : i + 1]
        runs = (runs ^ part) * _MIX
        runs ^= runs >> np.uint64(29)
    runs = np.unique(runs)
    bins = (runs >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], np.diff(bins) != 0])) if len(bins) else bins
    sketch = np.zeros(SKETCH, dtype=np.uint8)
    sketch[bins[first]] = (runs[first] % np.uint64(255)).astype(np.uint8) + 1
    again = [hashes]
    for _ in range(prints - 1):
        x = again[-1] * _MIX
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        again.append(x ^ (x >> np.uint64(32)))
    return [majority(h) for h in again], sketch.tobytes()


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of sketches, row by row."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    return np.where(used > 0, ((a == b) & (a > 0)).sum(axis=1) / np.maximum(used, 1), 1.0)


#: Pairs whose sketches a task compares at once.
SKETCH_BLOCK = 1 << 14
#: Links that a task remembers so as not to send their trees again; beyond that it starts afresh.
TREE = 1 << 18


def _hits(fps: DataFrame, tau: int, parts: int) -> DataFrame:
    """fps (fp), distinct -> (slot, fp, probe): index and probe rows with another print within tau bits in their bucket."""
    groups = bit_groups(fps, parts)
    counts = histogram(fps, groups)
    rows = bucket_rows(fps, tau, groups, counts, expected(counts, groups))

    def run(batches):
        slot0, fp0 = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for b in batches:
            slot, fp, probe = (c.to_numpy() for c in b.columns)
            own = probe == 0
            slots, known = np.concatenate([slot0, slot[own]]), np.concatenate([fp0, fp[own]])
            for i, j, near in _near(slots, known, slot[~own], fp[~own], tau):
                near &= known[j] != fp[~own][i]
                for at, where, of, side in ((np.unique(j[near]), slots, known, 0), (np.unique(i[near]), slot[~own], fp[~own], 1)):
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(where[at]), pa.array(of[at]), pa.array(np.full(len(at), side, dtype=np.int8))], ["slot", "fp", "probe"])
            if len(slot):
                last = slots == slot[-1]
                slot0, fp0 = slots[last], known[last]

    met = rows.repartition("slot").sortWithinPartitions("slot", "probe")
    return met.mapInArrow(run, "slot bigint, fp bigint, probe tinyint").distinct()


def _near(slots: np.ndarray, known: np.ndarray, ps: np.ndarray, pf: np.ndarray, tau: int):
    """Blocks of (places of probes, places of index rows of the same slot, which are within tau bits)."""
    low, high = np.searchsorted(slots, ps, "left"), np.searchsorted(slots, ps, "right")
    total = np.cumsum(high - low)
    cut = 0
    while cut < len(ps):
        end = max(cut + 1, int(np.searchsorted(total, (total[cut - 1] if cut else 0) + PAIR_BLOCK, "right")))
        n = (high - low)[cut:end]
        i = np.repeat(np.arange(cut, end), n)
        j = np.repeat(low[cut:end], n) + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        yield i, j, np.bitwise_count((pf[i] ^ known[j]).view(np.uint64)) <= tau
        cut = end


def similar(nodes: DataFrame, bound: float, tau: int = 7, parts: int = 4) -> DataFrame:
    """nodes (node, fp, sketch) -> (a, b): a spanning forest of all pairs within tau bits whose sketches agree in ``bound``
    or more. Pairs are verified before the forest is taken, those of one fingerprint too."""
    prints = written(nodes.groupBy("fp").agg(F.count("*").alias("many")), "prints")
    hits = _hits(prints.select("fp"), tau, parts)
    rows = hits.join(nodes, "fp").select("slot", "probe", "fp", "node", "sketch")
    # the nodes of one fingerprint: an index row in one of its slots, a probe row in each
    crowd = nodes.join(prints.where("many > 1"), "fp").withColumn("slots", F.ceil(F.col("many") / BUCKET_ROWS).cast("int"))
    at = lambda i: F.lit(-1).cast("long") - F.shiftrightunsigned(F.xxhash64("fp", i), 1)
    index = crowd.select(at(F.pmod(F.xxhash64("sketch"), F.col("slots")).cast("int")).alias("slot"), F.lit(0).cast("tinyint").alias("probe"), "fp", "node", "sketch")
    probe = crowd.withColumn("i", F.explode(F.expr("sequence(0, slots - 1)"))).select(at(F.col("i")).alias("slot"), F.lit(1).cast("tinyint").alias("probe"), "fp", "node", "sketch")

    def run(batches):
        empty = np.zeros(0, dtype=np.int64)
        slot0, fp0, node0, sketch0 = empty, empty, empty, np.zeros((0, SKETCH), dtype=np.uint8)
        tree = (empty, empty)
        for b in batches:
            if not b.num_rows:
                continue
            slot, probe, fp, node = (b.column(i).to_numpy() for i in range(4))
            sketch = np.frombuffer(b"".join(b.column(4).to_pylist()), dtype=np.uint8).reshape(-1, SKETCH)
            own = probe == 0
            slots, known, name, held = (np.concatenate(x) for x in ((slot0, slot[own]), (fp0, fp[own]), (node0, node[own]), (sketch0, sketch[own])))
            asking, asked = node[~own], sketch[~own]
            for i, j, near in _near(slots, known, slot[~own], fp[~own], tau):
                near &= asking[i] != name[j]
                i, j = i[near], j[near]
                good = [k + np.flatnonzero(alike(asked[i[k : k + SKETCH_BLOCK]], held[j[k : k + SKETCH_BLOCK]]) >= bound) for k in range(0, len(i), SKETCH_BLOCK)]
                if sum(map(len, good)):
                    good = np.concatenate(good)
                    # what this task has linked already is kept, so only links between its trees are new
                    x, y = np.concatenate([tree[0], asking[i[good]]]), np.concatenate([tree[1], name[j[good]]])
                    keep = spanning(x, y, (np.arange(len(x)) >= len(tree[0])).astype(np.int8))
                    new = keep[keep >= len(tree[0])]
                    tree = (x[keep], y[keep]) if len(keep) <= TREE else (x[new], y[new])
                    yield pa.RecordBatch.from_arrays([pa.array(x[new]), pa.array(y[new])], ["a", "b"])
            last = slots == slot[-1]
            slot0, fp0, node0, sketch0 = slots[last], known[last], name[last], held[last]

    met = rows.unionByName(index).unionByName(probe).repartition("slot").sortWithinPartitions("slot", "probe")
    return met.mapInArrow(run, "a bigint, b bigint")


def copies(docs: DataFrame, tau: int = 7, prints: int = PRINTS, similarity: float = 0.8, shingle: int = 5, slack: float = 0.04, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, th (hash of the text), keeper: a row for each document; True for the one that its group keeps, which is
    the one with the smallest key (null keys come last; of equal keys the one with the smallest th).

    Texts are linked if one of their ``prints`` pairs of fingerprints differs in at most ``tau`` bits and their
    sketches agree in ``similarity - slack`` of the bins or more; equal texts always are. A copy with added
    paragraphs shares a smaller part of its words than one with scattered edits, hence several fingerprints.
    Every pair within ``tau`` bits is verified, also of texts with one fingerprint, before a spanning forest is taken.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            pairs = [word_print((t.as_py() or b"").lower().split(), shingle, prints) for t in b.column(2).cast(pa.binary())]
            fps, sketches = zip(*pairs) if pairs else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], [key, "th", "fps", "sketch"])

    hashed = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"), text)
    made = written(hashed.mapInArrow(run, f"`{key}` {kind}, th bigint, fps array<bigint>, sketch binary"), "prints")
    texts = written(made.groupBy("th").agg(F.min(key).alias("low"), F.first("fps").alias("fps"), F.first("sketch").alias("sketch")), "texts")
    # texts with the same fingerprints and sketch are linked to the first of them
    nodes = written(texts.groupBy("fps", "sketch").agg(F.min("th").alias("node")), "nodes")
    links = texts.join(nodes, ["fps", "sketch"]).select(F.col("th").alias("a"), F.col("node").alias("b")).where("a <> b")
    for i in range(prints):
        links = links.union(similar(nodes.select("node", F.get("fps", F.lit(i)).alias("fp"), "sketch"), similarity - slack, tau))
    roots = components(links)
    member = texts.join(roots, texts.th == roots.node, "left").select("th", "low", F.coalesce("root", "th").alias("root"))
    first = F.struct(F.col("low").isNull().alias("none"), "low", "th")
    best = member.groupBy("root").agg(F.min(first).alias("best"))
    kept = member.join(best, "root").select("th", (first == F.col("best")).alias("chosen"), F.col("best.low").alias("low"))
    named = made.select(F.col(key).alias("key"), "th").join(kept, "th")
    return named.select(F.col("key").alias(key), "th", (F.col("chosen") & F.col("key").eqNullSafe(F.col("low"))).alias("keeper"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The documents, one of each group of near copies: the one with the smallest key. Of rows that repeat
    that key and text one stays. All columns are kept, whatever their names."""
    own = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    marked = copies(own, key="key", text="text", **how).where("keeper").groupBy("key", "th").agg((F.count("*") > 1).alias("again"))
    marked = written(marked, "keepers").select(F.col("key").alias("k"), F.col("th").alias("t"), "again")
    th = F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{key}`").alias("key"), th.alias("th"))
    found = rows.join(marked.hint("shuffle_hash"), (F.col("th") == F.col("t")) & F.col("key").eqNullSafe(F.col("k")))
    one = found.where("again").dropDuplicates(["key", "th"])
    return found.where("not again").select("row").union(one.select("row")).select(*[F.col("row")[c].alias(c) for c in docs.columns])
