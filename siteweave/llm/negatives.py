"""Hard-negative mining by Fagin's threshold algorithm over blocks of vectors.

Components become integers, so scores are exact. Candidates are packed into blocks; each block has, for each
dimension, its rows sorted by that component. A task holds a block of anchors with what they have found so far and
streams candidate blocks past it. Sorted access reads the lists from the end that an anchor's sign prefers, to a depth
that grows fourfold; new rows are scored at once for all anchors of a tile that are still active (random access, one
product of matrices). An anchor stops in a block once its threshold, the score of an imagined row that stands at the
present depth of every list, is strictly below the k-th score of each of its windows; a block whose best imagined row
is below that is not read at all. Ties are therefore complete.

Two passes: the first finds the k best rows of an anchor's own label (its positives), the second, for each positive,
the best rows of other labels whose score lies in a window below the positive's.

A task is (block of anchors, run of candidate blocks). Runs split the candidates only as far as tasks are wanted, so
results to merge are few for each anchor; with many anchors there is one run, and candidates are sent once for each
block of anchors. Nothing grows with a label's or a vector's copies: state is k rows for each window.

Defined edge cases: rows with a null key, label or vector, or a null or non-finite component take no part; rows of one
key take part one by one and are never each other's partners; shorter vectors count as filled up with zeros; labels
are integers; a score beyond 64 bits counts as the nearest 64-bit number; columns besides key, vector and label aren't read;
an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siteweave.plans.store import discard, written

#: Rows of a candidate block, anchors of a block and of a tile, and numbers of a block (8 bytes each), at most.
BLOCK, ANCHORS, TILE, NUMBERS = 8192, 16384, 1024, 1 << 22
#: Fewer rows aren't dealt to several tasks.
LEAST = 1024
_PACKED = "part int, seq int, n int, ids binary, labels binary, kind string, width int, numbers binary"
_FOUND = "part int, row bigint, n int, anchor_id bigint, id bigint, score bigint, given bigint"
_LONG = np.iinfo(np.int64)  # its bounds are Python integers


def _pack(scale: float, most: int):
    """Batches of (id, label, vector) -> blocks; numbers in the narrowest type that holds them."""

    def block(part, seq, ids, labels, rows):
        lists = rows.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        sizes = np.diff(rows.offsets.to_numpy())
        full = np.zeros((len(ids), int(sizes.max(initial=0))))
        full[np.arange(full.shape[1]) < sizes[:, None]] = np.floor(scale * lists)
        top = np.abs(full).max(initial=0)
        kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<f8"
        row = {"part": part, "seq": seq, "n": len(ids), "ids": ids.tobytes(), "labels": labels.tobytes(), "kind": kind, "width": full.shape[1], "numbers": full.astype(kind).tobytes()}
        return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()), ("kind", pa.string()), ("width", pa.int32()), ("numbers", pa.binary())]))

    def run(batches):
        part, seq, waiting, held = TaskContext.get().partitionId(), 0, [], 0
        for b in batches:
            at = 0
            while at < b.num_rows:
                size = max(1, pa.compute.max(pa.compute.list_value_length(b.column(2))).as_py() or 1)
                step = min(b.num_rows - at, max(1, min(most, NUMBERS // size) - held))
                waiting.append(b.slice(at, step))
                held, at = held + step, at + step
                if held >= min(most, NUMBERS // size):
                    yield from done(part, seq, waiting)
                    seq, waiting, held = seq + 1, [], 0
        if held:
            yield from done(part, seq, waiting)

    def done(part, seq, waiting):
        t = pa.Table.from_batches(waiting).combine_chunks()
        rows = t.column(2).chunk(0)
        yield block(part, seq, t.column(0).to_numpy(), t.column(1).to_numpy(), pa.ListArray.from_arrays(pa.array(rows.offsets.to_numpy() - rows.offsets[0].as_py(), pa.int32()), rows.flatten()))

    return run


class Block:
    """Rows of one or several packed blocks with their sorted lists, made when they are first read."""

    def __init__(self, packed: list[dict]):
        self.ids, self.labels = (np.concatenate([np.frombuffer(p[c], np.int64) for p in packed]) for c in ("ids", "labels"))
        self.part = np.concatenate([np.full(p["n"], p["part"]) for p in packed])
        self.row = np.concatenate([np.arange(p["n"]) + (p["seq"] << 20) for p in packed])
        self.numbers, at = np.zeros((len(self.ids), max(p["width"] for p in packed))), 0
        for p in packed:
            self.numbers[at : at + p["n"], : p["width"]] = np.frombuffer(p["numbers"], p["kind"]).reshape(p["n"], p["width"])
            at += p["n"]
        self.largest = float(np.abs(self.numbers).max(initial=0))
        self.kinds = np.unique(self.labels)
        self._order = None

    def wide(self, width: int) -> np.ndarray:
        return np.pad(self.numbers, ((0, 0), (0, width - self.numbers.shape[1]))) if width > self.numbers.shape[1] else self.numbers

    def order(self) -> np.ndarray:
        """rank, dimension -> row, ascending."""
        if self._order is None:
            self._order = np.argsort(self.numbers, axis=0, kind="stable")
        return self._order


class Best:
    """The k best (score, id) of each window; lowest is the least score that still counts."""

    def __init__(self, lows: list[int], highs: list[int], k: int, exact=np.float64):
        self.k, self.kind = k, exact
        self.high, self.bound = np.array(highs, exact), np.array(lows, exact)
        self.window, self.score, self.id = np.zeros(0, np.int64), np.zeros(0, exact), np.zeros(0, np.int64)

    def offer(self, window, score, ids) -> None:
        window, score, ids = (np.concatenate(x) for x in ((self.window, window), (self.score, score), (self.id, ids)))
        order = score if score.dtype != object else np.unique(score, return_inverse=True)[1]
        by = np.lexsort((ids, -order, window))
        window, score, ids = window[by], score[by], ids[by]
        place = np.arange(len(window)) - np.searchsorted(window, window)
        keep = place < self.k
        self.window, self.score, self.id, place = window[keep], score[keep], ids[keep], place[keep]
        last = place == self.k - 1
        self.bound[self.window[last]] = self.score[last]


class Tile:
    """Anchors with what they have found. windows: (row, n, given score) of each window, rows ascending."""

    def __init__(self, of: Block, cut: slice, windows: list[tuple[int, int, int]], limits, k: int, alike: bool):
        self.part, self.row, self.ids, self.labels, self.numbers, self.alike = of.part[cut], of.row[cut], of.ids[cut], of.labels[cut], of.numbers[cut], alike
        self.windows, self.largest = windows, float(np.abs(self.numbers).max(initial=0))
        self.of = np.array([w[0] for w in windows], np.int64)  # place of a window's anchor in the tile
        big = max((abs(w[2]) for w in windows), default=0) > 1 << 46
        self.best = Best(*limits, k, object if big else np.float64)

    def exact(self, block: Block):
        """The type in which scores of both are exact."""
        most = self.largest * block.largest * max(self.numbers.shape[1], block.numbers.shape[1], 1)
        return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 46 else object

    def meet(self, block: Block) -> None:
        """Sorted access by depth, random access to what is new, until every anchor's threshold is below its windows."""
        if not len(self.windows) or not len(block.ids) or (self.alike and not np.isin(self.labels, block.kinds).any()):
            return
        width = max(self.numbers.shape[1], block.numbers.shape[1])
        kind = self.exact(block)
        if kind is object and self.best.kind is not object:
            self.best.kind = object
            self.best.high, self.best.bound, self.best.score = (np.array([x if np.isinf(x) else int(x) for x in a], object) for a in (self.best.high, self.best.bound, self.best.score))
        mine = np.pad(self.numbers, ((0, 0), (0, width - self.numbers.shape[1])))
        rows = block.wide(width)
        listed = block.numbers.shape[1]
        up, down = np.maximum(mine[:, :listed], 0), np.minimum(mine[:, :listed], 0)
        n, seen, depth = len(block.ids), np.zeros(len(block.ids), bool), 0
        order = block.order()
        as_kind = lambda x: np.vectorize(int, otypes=[object])(x) if kind is object and x.size else x.astype(kind)
        fast = as_kind(rows)
        mine_fast = as_kind(mine)
        useful = np.isin(self.labels, block.kinds) if self.alike else np.ones(len(self.ids), bool)
        while depth < n:
            tops = block.numbers[order[n - 1 - depth], np.arange(listed)] if listed else np.zeros(0)
            bottoms = block.numbers[order[depth], np.arange(listed)] if listed else np.zeros(0)
            # in object arithmetic the float threshold may be off by rounding: a little slack keeps it an upper bound
            threshold = up @ tops + down @ bottoms
            if kind is object:
                threshold = np.maximum(threshold + np.abs(threshold) * 1e-9, float(_LONG.min))
            open_ = np.zeros(len(self.ids), bool)
            open_[self.of[np.asarray(threshold[self.of] >= self.best.bound, bool) & np.asarray(self.best.high >= self.best.bound, bool)]] = True
            open_ &= useful
            if not open_.any():
                return
            active = np.flatnonzero(open_)
            deep = min(n, max(1, 4 * depth))
            fresh = np.zeros(n, bool)
            rising, falling = (up[active] > 0).any(0), (down[active] < 0).any(0)
            fresh[order[n - deep : n - depth][:, rising]] = True
            fresh[order[depth:deep][:, falling]] = True
            if deep == n:
                fresh[:] = True
            new = np.flatnonzero(fresh & ~seen)
            seen[new] = True
            depth = deep
            if len(new):
                scores = mine_fast[active] @ fast[new].T
                if kind is object:
                    scores = np.minimum(np.maximum(scores, _LONG.min), _LONG.max)
                self._offer(active, scores, block.ids[new], block.labels[new])

    def _offer(self, active, scores, ids, labels) -> None:
        place = np.full(len(self.ids), -1)
        place[active] = np.arange(len(active))
        allowed = (self.labels[active, None] == labels) == self.alike
        allowed &= self.ids[active, None] != ids
        first = np.searchsorted(self.of, np.arange(len(self.ids) + 1))
        found = []
        for nth in range(int(np.diff(first).max(initial=0))):  # the nth window of every anchor at once
            w = first[:-1][active] + nth
            has = w < first[1:][active]
            if has.any():
                w, part = w[has], scores[has]
                a, c = np.nonzero(np.asarray((part >= self.best.bound[w, None]) & (part <= self.best.high[w, None]), bool) & allowed[has])
                found.append((w[a], part[a, c].astype(self.best.kind), ids[c]))
        window, score, who = (np.concatenate([f[i] for f in found]) for i in range(3))
        if len(window):
            self.best.offer(window, score, who)

    def rows(self):
        for w, score, who in zip(self.best.window, self.best.score, self.best.id):
            at, n, given = self.windows[w]
            yield int(self.part[at]), int(self.row[at]), n, int(self.ids[at]), int(who), int(score), given


def _tiles(packed: list[dict], given: dict | None, k: int, low: int, high: int):
    """Tiles of anchors. given: (part, row) -> [(n, score)] for the second pass."""
    b = Block(packed)
    for at in range(0, len(b.ids), TILE):
        cut = slice(at, at + TILE)
        places = list(zip(b.part[cut].tolist(), b.row[cut].tolist()))
        if given is None:
            windows = [(i, 0, 0) for i in range(len(places))]
            limits = [-np.inf] * len(windows), [np.inf] * len(windows)
        else:
            windows = [(i, n, s) for i, place in enumerate(places) for n, s in given.get(place, ())]
            limits = [-(-low * w[2] // 100) for w in windows], [high * w[2] // 100 for w in windows]
        yield Tile(b, cut, windows, limits, k, given is None)


def _pass(anchors: DataFrame, blocks: DataFrame, parts: int, runs: int, k: int, low: int, high: int, positives: DataFrame | None) -> DataFrame:
    empty = "array<struct<row: bigint, n: int, id: bigint, score: bigint>>"
    task = lambda run: F.pmod("part", F.lit(parts)) * runs + run
    names = [c.split()[0] for c in _PACKED.split(", ")]
    asked = anchors.withColumn("task", F.explode(F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), task))).select("task", F.lit(1).alias("step"), *names, F.lit(None).cast(empty).alias("given"))
    shown = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("task", F.col("task") * runs + F.pmod(F.col("part") + F.col("seq"), F.lit(runs)))
    stream = asked.unionByName(shown.select("task", F.lit(2).alias("step"), *names, F.lit(None).cast(empty).alias("given")))
    if positives is not None:
        lists = positives.groupBy("part").agg(F.collect_list(F.struct("row", "n", "id", "score")).alias("given"))  # k for each of a part's anchors
        told = lists.withColumn("task", F.explode(F.transform(F.sequence(F.lit(0), F.lit(runs - 1)), task)))
        stream = stream.unionByName(told.select("task", F.lit(0).alias("step"), "given", "part"), allowMissingColumns=True)
    dealt = stream.repartitionById(parts * runs, F.col("task")).sortWithinPartitions("step", "part", "seq")
    schema = pa.schema([("part", pa.int32()), ("row", pa.int64()), ("n", pa.int32()), ("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("given", pa.int64())])
    second = positives is not None

    def run(batches):
        tiles, asked, waiting, given = [], [], [], {} if second else None

        def meet():
            if asked:
                tiles.extend(_tiles(asked, given, k, low, high))
                asked.clear()
            if waiting:
                block = Block(waiting)
                waiting.clear()
                for t in tiles:
                    t.meet(block)

        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                if row["step"] == 0:
                    for p in row["given"]:
                        given.setdefault((row["part"], p["row"]), []).append((p["n"], p["score"]))
                elif row["step"] == 1:
                    asked.append(row)
                else:
                    if waiting and sum(w["n"] for w in waiting) + row["n"] > BLOCK:
                        meet()
                    waiting.append(row)
        meet()
        for t in tiles:
            rows = list(t.rows())
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return dealt.mapInArrow(run, _FOUND)


def mine(vectors: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x); scores are inner products, ties go to the smaller key. An anchor's positives
    are its best rows of the same label; for each, the best rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score follow by rank.
    """
    spark = vectors.sparkSession
    whole = ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.where(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & whole)
    rows = good.select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(anchors, F.lit(False)).alias("asks"))
    counted = rows.agg(F.count("*"), F.count_if("asks")).first()  # one row
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = max(1, -(-counted[0] // BLOCK), min(wanted, -(-counted[0] // LEAST)))
    parts = max(1, -(-counted[1] // ANCHORS))
    runs = max(1, min(cuts, -(-wanted // parts)))
    packed = lambda df, n, most, name: written(df.repartitionByRange(n, "label", "id").sortWithinPartitions("label", "id").select("id", "label", "vector").mapInArrow(_pack(scale, most), _PACKED), name)
    asks, blocks = packed(rows.where("asks"), parts, ANCHORS, "anchors"), packed(rows, cuts, BLOCK, "vectors")
    order = Window.partitionBy("part", "row").orderBy(F.desc("score"), "id")
    liked = _pass(asks, blocks, parts, runs, positives, low, high, None).drop("n").withColumn("n", F.row_number().over(order)).where(F.col("n") <= positives)
    liked = written(liked.select("part", "row", "n", "anchor_id", "id", "score"), "positives")
    window = Window.partitionBy("part", "row", "n").orderBy(F.desc("score"), "id")
    found = _pass(asks, blocks, parts, runs, negatives, low, high, liked).withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= negatives)
    pair = liked.select("part", "row", "n", F.col("id").alias("positive_id"))
    out = found.join(pair, ["part", "row", "n"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), F.col("given").alias("positive_score"), F.col("score").alias("negative_score"))
    out = written(out, "negatives")
    for table in (asks, blocks, liked):
        discard(table)
    return out
