"""Packing of tokenised documents into sequences of a fixed length.

A document's ids (with one end id) are cut into whole sequences and a rest. The rests are
packed shortest pack first over the histogram of lengths: the histogram has as many bins as
a sequence has tokens, so the plan is made on the driver from bounded data, whatever the
number of documents. Each piece knows its rank among the pieces of its length, and the
plan's rank ranges say where it goes; no sort or shuffle of the ids is needed.

Defined edge cases: a null or empty text is one piece holding the end id; repeated rows are
packed one by one; columns besides key and text are not read; an empty table gives none.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteweave.llm import tokens
from siteweave.plans.store import written

LENGTH = 1024
END = 0


def pieces(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, start, length, ids_crc32, doc_tokens, and part, nth: the task and the count of that length so far in it."""
    path = tokenizer or tokens.default_path()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "part", "nth"]

    def run(batches):
        part, seen = TaskContext.get().partitionId(), np.zeros(length + 1, dtype=np.int64)
        for b in batches:
            ids, n = tokens.with_end(*tokens.encoder(path).encode(b.column(1)), END)
            first = np.cumsum(n) - n
            times = -(-n // length)
            doc = np.repeat(np.arange(len(n)), times)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(times) - times, times)) * length
            size = np.minimum(length, n[doc] - start)
            raw, at = memoryview(ids).cast("B"), 4 * (first[doc] + start)
            crc = [zlib.crc32(raw[x : x + y]) for x, y in zip(at.tolist(), (4 * size).tolist())]
            # the pieces of one length are counted on, in their order
            order = np.argsort(size, kind="stable")
            many = np.bincount(size, minlength=length + 1)
            nth = np.empty(len(size), dtype=np.int64)
            nth[order] = np.arange(len(size)) + (seen - (np.cumsum(many) - many))[size[order]]
            seen += many
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), *[pa.array(c, pa.int64()) for c in (start, size, crc, n[doc], np.full(len(doc), part), nth)]], names
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} bigint" for c in names[1:]))


def plan(histogram: dict[int, int], length: int = LENGTH) -> list[tuple[int, list[int]]]:
    """(how often, lengths of one pack, longest first), for all pieces of the histogram."""
    open_: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)  # by free space
    done = []
    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            space = max((s for s in open_ if open_[s]), default=0)  # the shortest pack
            if space >= size:
                count, packed = open_[space].pop()
                take = min(count, left)
                if count > take:
                    open_[space].append((count - take, packed))
            else:
                space, take, packed = length, left, []
            left -= take
            (open_[space - size] if space > size else done).append((take, packed + [size]))
    return done + [x for s in sorted(open_) for x in open_[s]]


def places(packs: list[tuple[int, list[int]]], length: int = LENGTH) -> dict[str, np.ndarray]:
    """For each length and range of ranks: the first sequence, how many of that length a sequence takes, their offset."""
    used: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for count, sizes in packs:
        offset = 0
        for size in dict.fromkeys(sizes):
            times = sizes.count(size)
            rows.append((size << 48 | used[size], used[size], sequence, times, offset))
            used[size] += count * times
            offset += size * times
        sequence += count
    rows.sort()
    return {n: np.array([r[i] for r in rows], dtype=np.int64) for i, n in enumerate(("at", "first", "sequence", "times", "offset"))}


def packed(docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = written(pieces(docs, length, tokenizer, key, text), "pieces")
    by_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `length` rows
    table = docs.sparkSession.sparkContext.broadcast(places(plan(histogram, length), length))  # bounded by the histogram's bins
    ranked = cut.join(base, ["part", "length"]).select(key, "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("nth")).alias("rank"))
    out = ranked.schema.names[:-1] + ["sequence_id", "offset"]

    def run(batches):
        t = table.value
        for b in batches:
            size, rank = b.column(2).to_numpy(), b.column(5).to_numpy()
            i = np.searchsorted(t["at"], size << 48 | rank, "right") - 1
            q = rank - t["first"][i]
            sequence = t["sequence"][i] + q // t["times"][i]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(t["offset"][i] + q % t["times"][i] * size)], out)

    kind = docs.schema[key].dataType.simpleString()
    return ranked.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{c} bigint" for c in out[1:]))
