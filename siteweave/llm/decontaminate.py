"""Benchmark decontamination with an FM-index over each shard of training text.

A shard is a run of documents inside a task. Its words become numbers of the benchmark's
vocabulary; only runs of such words at least as long as the shortest phrase can hold an
occurrence, so only those are indexed (nothing is lost by that). The index is a suffix
array sorted by doubling, its Burrows-Wheeler transform in a wavelet tree of ranked bit
vectors, and every ``SAMPLE``-th suffix position. All phrases are searched backwards at
once, occurrences are located by walking to a sampled position, and the spans are merged.

The benchmark is read in blocks of at most ``BLOCK_BYTES`` of text, one pass over the
documents for each block, so what the driver holds and sends to the tasks is bounded.

Defined edge cases: null and wordless texts have no words and no hits; items without words
are ignored; equal items and repeated item ids count as separate occurrences of their
distinct ids; the passages of an item without an id are hit, it is not listed or counted;
repeated rows of documents are treated one by one; extra columns are kept and
may have any name; empty tables give empty results (no benchmark: nothing is hit).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.plans.store import written

WINDOW = 10
SAMPLE = 16
SHARD_CHARS = 8 << 20
BLOCK_BYTES = 8 << 20

#: Byte by byte: lower case for letters, blanks for what isn't part of a word.
TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after A-Z are lowered."""
    return (text or b"").translate(TO_WORDS).split()


# --- the index -------------------------------------------------------------------------

class Ranks:
    """A bit vector with the number of ones before each place."""

    def __init__(self, bits: np.ndarray):
        self.ones = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    def before(self, at: np.ndarray, bit: np.ndarray) -> np.ndarray:
        ones = self.ones[at]
        return np.where(bit, ones, at - ones)


class Wavelet:
    """Ranks of symbols in a sequence, one bit vector for each bit of a symbol (highest first)."""

    def __init__(self, symbols: np.ndarray, width: int):
        self.levels, self.zeros, self.width = [], [], width
        now = symbols
        for level in range(width - 1, -1, -1):
            bit = (now >> level) & 1
            self.levels.append(Ranks(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            now = np.concatenate([now[bit == 0], now[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        low = np.zeros_like(at)
        for k, (r, zeros) in enumerate(zip(self.levels, self.zeros)):
            bit = ((symbol >> (self.width - 1 - k)) & 1).astype(bool)
            shift = np.where(bit, zeros, 0)
            low, at = shift + r.before(low, bit), shift + r.before(at, bit)
        return at - low


def suffix_array(text: np.ndarray) -> np.ndarray:
    """By doubling: ranks of 1, 2, 4 ... symbols, until all differ."""
    n, step = len(text), 1
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    while True:
        after = np.full(n, 0)
        after[: max(0, n - step)] = rank[step:] + 1
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        if not n or rank[order[-1]] == n - 1:
            return order
        step *= 2


class FMIndex:
    """Over symbols >= 2; 1 ends every run, so no phrase crosses from one run to the next, and one 0 ends the text."""

    def __init__(self, text: np.ndarray):
        self.order = suffix_array(text)
        last = text[self.order - 1]
        self.bwt = last
        top = int(text.max()) + 1
        self.wavelet = Wavelet(last, max(1, int(top).bit_length()))
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 1))])
        self.n = len(text)
        self.sampled = self.order % SAMPLE == 0
        self.kept = self.order[self.sampled]
        self.slot = np.cumsum(self.sampled) - 1

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of each phrase (a row of symbols, filled up on the left)."""
        low, high = np.zeros(len(phrases), dtype=np.int64), np.full(len(phrases), self.n)
        for i in range(phrases.shape[1] - 1, -1, -1):
            on = np.flatnonzero((phrases.shape[1] - i <= lengths) & (low < high))
            if not len(on):
                break
            c = phrases[on, i]
            known = c < len(self.before) - 1
            low[on[~known]] = high[on[~known]] = 0
            on, c = on[known], c[known]
            low[on] = self.before[c] + self.wavelet.rank(c, low[on])
            high[on] = self.before[c] + self.wavelet.rank(c, high[on])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of rows: each goes one symbol back until it meets a sampled suffix."""
        out, steps, at = np.zeros(len(rows), dtype=np.int64), np.zeros(len(rows), dtype=np.int64), rows.copy()
        todo = np.arange(len(rows))
        while len(todo):
            done = self.sampled[at[todo]]
            hit = todo[done]
            out[hit] = self.kept[self.slot[at[hit]]] + steps[hit]
            todo = todo[~done]
            c = self.bwt[at[todo]]
            at[todo] = self.before[c] + self.wavelet.rank(c, at[todo])
            steps[todo] += 1
        return out


# --- phrases ---------------------------------------------------------------------------

class Phrases:
    """The distinct windows of a block of items, as numbers of the block's vocabulary."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple, int] = {}
        self.items: list[list[str]] = []
        for item, text in items:
            numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            if numbers:
                for i in range(max(1, len(numbers) - window + 1)):
                    at = found.setdefault(tuple(numbers[i : i + window]), len(found))
                    if at == len(self.items):
                        self.items.append([])
                    if item is not None:
                        self.items[at].append(str(item))
        self.lengths = np.array([len(p) for p in found], dtype=np.int64)
        self.rows = np.zeros((len(found), window), dtype=np.int64)
        for i, p in enumerate(found):
            self.rows[i, window - len(p) :] = p
        self.shortest = int(self.lengths.min()) if len(found) else 0


def shard_hits(numbers: np.ndarray, starts: np.ndarray, phrases: Phrases):
    """Occurrences in a shard: word places and phrases. ``numbers`` of all documents in a row, 0 for foreign
    words; starts: where each document begins (no occurrence may cross it)."""
    cut = np.zeros(len(numbers) + 1, dtype=bool)
    cut[starts[starts < len(numbers)]] = True
    known = numbers > 0
    begins = known & (cut[:-1] | ~np.concatenate([[False], known[:-1]]))
    ends = known & (cut[1:] | ~np.concatenate([known[1:], [False]]))
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long = last - first >= phrases.shortest
    first, last = first[long], last[long]
    if not len(first):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    size = last - first + 1  # with an end mark
    offset = np.cumsum(size) - size
    place = np.repeat(first - offset, size) + np.arange(size.sum())
    ended = np.zeros(len(place), dtype=bool)
    ended[offset + size - 1] = True
    text = np.where(ended, 1, numbers[np.minimum(place, len(numbers) - 1)] + 1)
    text, place = np.append(text, 0), np.append(place, -1)
    index = FMIndex(text)
    low, high = index.search(phrases.rows + 1, phrases.lengths)
    n = high - low
    rows = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return place[index.locate(rows)], np.repeat(np.arange(len(n)), n)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def _pass(rows: DataFrame, items: list[tuple], window: int, then: str | None = None) -> DataFrame:
    """rows (__row, __text, __n_words, __spans, __items) with this block's hits added. ``then``: what becomes of the
    text: "clean" takes the spans out of it, "drop" makes it null."""
    phrases = rows.sparkSession.sparkContext.broadcast(Phrases(items, window))  # at most BLOCK_BYTES of text

    def shard(batch):
        p = phrases.value
        get, sizes, numbers = p.vocabulary.get, [], []
        texts = batch.column("__text").cast(pa.binary())
        for t in texts:
            w = words_of(t.as_py())
            sizes.append(len(w))
            numbers.append(np.fromiter((get(x, 0) for x in w), dtype=np.int32, count=len(w)))
        sizes = np.array(sizes, dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        new: dict[int, tuple[list, set]] = {}
        if len(p.lengths) and sizes.sum():
            place, which = shard_hits(np.concatenate(numbers), starts, p)
            doc = np.searchsorted(starts, place, "right") - 1
            for d, a, i in zip(doc.tolist(), (place - starts[doc]).tolist(), which.tolist()):
                own = new.setdefault(d, ([], set()))
                own[0].append((a, a + int(p.lengths[i])))
                own[1].update(p.items[i])
        columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        columns["__n_words"] = pa.array(sizes)
        if new:
            spans, items = columns["__spans"].to_pylist(), columns["__items"].to_pylist()
            for d, (found, names) in new.items():
                old = [(x["start"], x["end"]) for x in spans[d]]
                spans[d] = [{"start": a, "end": b} for a, b in merged(old + found)]
                items[d] = sorted(names.union(items[d]))
            columns["__spans"] = pa.array(spans, batch.schema.field("__spans").type)
            columns["__items"] = pa.array(items, batch.schema.field("__items").type)
        if then == "drop":
            columns["__text"] = pa.nulls(batch.num_rows, pa.string())
        if then == "clean" and pc.sum(columns["__spans"].value_lengths()).as_py():
            spans = columns["__spans"].to_pylist()
            kept = [without_spans(t.as_py(), [(x["start"], x["end"]) for x in own]) if own else t.as_py() for t, own in zip(texts, spans)]
            columns["__text"] = pa.array(kept, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def run(batches):
        """Shards of about SHARD_CHARS, whatever the size of the batches."""
        waiting, size = [], 0
        for whole in batches:
            step = max(1, whole.num_rows * SHARD_CHARS // max(1, whole.column("__text").nbytes))
            for i in range(0, whole.num_rows, step):
                b = whole.slice(i, step)
                waiting.append(b)
                size += b.column("__text").nbytes
                if size >= SHARD_CHARS:
                    yield from (shard(x) for x in pa.Table.from_batches(waiting).combine_chunks().to_batches())
                    waiting, size = [], 0
        if waiting:
            yield from (shard(x) for x in pa.Table.from_batches(waiting).combine_chunks().to_batches())

    return rows.mapInArrow(run, rows.schema)


def blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple]]:
    """The stated phrases in blocks of at most BLOCK_BYTES (an item that is longer is a block), one after the other; one at least."""
    block, size = [], 0
    rows = benchmark.select(F.col(item).alias("i"), F.col(text).cast("binary").alias("t")).where("t is not null")
    for r in rows.toLocalIterator():
        if size and size + len(r.t) > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((r.i, bytes(r.t)))
        size += len(r.t)
    yield block


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text", item: str = "item_id", item_text: str = "text", carry: list[str] | None = None, then: str | None = None) -> DataFrame:
    """__row (struct of the carried columns), __text, __n_words, __spans of hit words [start, end), __items.

    The blocks of the benchmark are treated in turn: the driver and the tasks hold one at a time, and where
    there are several the rows are written between them."""
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    rows = docs.select(
        F.struct(*([F.col(f"`{c}`") for c in carry] or [F.lit(0).alias("none")])).alias("__row"),
        F.col(f"`{text}`").alias("__text"),
        F.lit(0).cast("long").alias("__n_words"),
        F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)").alias("__spans"),
        F.expr("cast(array() as array<string>)").alias("__items"),
    )
    last = None
    for block in blocks(benchmark, item, item_text):
        if last is not None:
            rows = written(_pass(rows, last, window), "hits")
        last = block
    return _pass(rows, last, window, then)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_words, n_hit, n_items, items_sha256, contaminated: a row for each document."""
    found = hits(docs, benchmark, window, text, carry=[key], then="drop")
    n_hit = F.aggregate("__spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        F.col("__row")[key].alias(key),
        F.col("__n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.size("__spans") > 0).alias("contaminated"),
    )


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what lies between them."""
    clean, places, at = text.translate(TO_WORDS), [], 0
    for w in clean.split():
        at = clean.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : places[a][0]])
        last = places[b - 1][1]
    return b"".join(out + [text[last:]])


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """The documents with the hit passages taken out of their texts; other columns as they are."""
    found = hits(docs, benchmark, window, text, then="clean")
    return found.select(*[F.col("__text").alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns])
