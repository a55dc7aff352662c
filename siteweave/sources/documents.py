"""Large JSON documents read by several tasks: the objects of top-level arrays, one row each.

A whole document in one row, as the JSON source's ``multiLine`` gives it, puts a file of any size into one task. Here Spark's
text source cuts files by byte ranges in whatever store they lie, with ``}`` as the end of a line, so a task gets the pieces of
its range in order. Where a range begins inside the document isn't known to its task, but can be summed up: a range changes the
depth of brackets by so much if it begins outside a string, by so much if inside, and so on. Two passes:

1. every range tells, for both beginnings, how it ends: inside a string or not, the change of depth, the least depth, and the
   last key at each depth. A walk over the ranges of each file, a row each, gives every range's true beginning.
2. every range cuts out the objects that begin in it. One that reaches into the next ranges is sent in parts, which are
   joined by the range in which it began.

Defined edge cases: only objects count as items, as other values of such an array would be null rows; a name that isn't a
top-level array of objects, an empty file and an empty array give no rows; of a name that occurs twice the items of both follow;
a document that ends inside a value makes the read fail; names of arrays don't contain ``}``.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OPEN, _CLOSE = b"{[", b"}]"
#: Bytes looked at together within a range.
CHUNK = 4 << 20
#: Depth inside an item: document, array, item.
ITEM = 3
_KEYS = "map<int,string>"
_SUMMARY = "file string, start bigint, odd boolean, " + ", ".join(f"change{h} int, least{h} int, keys{h} {_KEYS}" for h in (0, 1))
_ITEMS = "file string, range bigint, nth bigint, name string, begun bigint, part bigint, body string"


def _chunks(batches):
    """(file, start of the range, bytes, ends) of rows in order; ends marks the last bytes of a range that this task sees."""
    at, held, size = None, [], 0
    for b in batches:
        if not b.num_rows:
            continue
        files, starts, values = b.column(0), b.column(1).to_numpy(), b.column(2).cast(pa.large_binary())
        offsets = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
        data = values.buffers()[2]
        cut = [0, *(np.flatnonzero(np.diff(starts)) + 1).tolist(), b.num_rows]
        for i, j in zip(cut, cut[1:]):
            # files of equal starts follow one another in a batch: split by name as well
            while i < j:
                name, k = files[i].as_py(), i + 1
                if files[j - 1].as_py() == name:
                    k = j
                else:
                    while files[k].as_py() == name:
                        k += 1
                place = (name, int(starts[i]))
                if at is not None and place != at:
                    yield *at, b"".join(held), True
                    held, size = [], 0
                at = place
                for r in range(i, k):
                    piece = data[int(offsets[r]) : int(offsets[r + 1])].to_pybytes() if data is not None else b""
                    held += [piece, b"}"]
                    size += len(piece) + 1
                    if size >= CHUNK:
                        yield *at, b"".join(held), False
                        held, size = [], 0
                i = k
    if at is not None:
        yield *at, b"".join(held), True


def _marks(data: bytes, inside: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
    """Places outside strings of brackets (with +1 or -1) and colons, places of quotes, and whether the end is inside a string."""
    b = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(b == 34)
    if len(quotes):
        before = quotes[(quotes > 0) & (b[quotes - 1] == 92)]
        escaped = []
        for q in before.tolist():
            n = q - 1
            while n >= 0 and b[n] == 92:
                n -= 1
            if (q - 1 - n) % 2:
                escaped.append(q)
        quotes = np.setdiff1d(quotes, escaped, assume_unique=True) if escaped else quotes
    found = np.flatnonzero((b == 123) | (b == 125) | (b == 91) | (b == 93) | (b == 58))
    outside = found[(np.searchsorted(quotes, found) + inside) % 2 == 0]
    kind = b[outside]
    colon = kind == 58
    return outside[~colon], np.where((kind[~colon] == 123) | (kind[~colon] == 91), 1, -1), outside[colon], quotes, bool((len(quotes) + inside) % 2)


def _key_before(data: bytes, colon: int, quotes: np.ndarray) -> str | None:
    """The string that ends right before a colon."""
    i = int(np.searchsorted(quotes, colon))
    if i < 2 or data[quotes[i - 1] + 1 : colon].strip():
        return None
    return data[quotes[i - 2] + 1 : quotes[i - 1]].decode("utf-8", "replace")


class _Sum:
    """What a range does to a beginning inside or outside a string."""

    def __init__(self, inside: bool):
        self.inside, self.depth, self.least, self.keys = inside, 0, 0, {}

    def feed(self, data: bytes) -> None:
        places, steps, colons, quotes, self.inside = _marks(data, self.inside)
        depth = self.depth + np.cumsum(steps)
        if len(colons):
            at = np.searchsorted(places, colons)
            of = np.where(at > 0, depth[np.maximum(at - 1, 0)] if len(depth) else self.depth, self.depth)
            last = {int(d): int(c) for c, d in zip(colons, of)} if len(of) < 64 else {int(d): int(colons[len(of) - 1 - i]) for d, i in zip(*np.unique(of[::-1], return_index=True))}
            for d, c in last.items():
                self.keys[d] = _key_before(data, c, quotes) or self.keys.get(d)
        if len(depth):
            self.least = min(self.least, int(depth.min()))
            self.depth = int(depth[-1])
        # keys of objects deeper than the document are never names of its arrays; those of lower depths may be
        if len(self.keys) > 64:
            self.keys = {d: k for d, k in self.keys.items() if d <= self.least + 2}


def _summaries(batches):
    rows, sums, at = [], None, None
    for file, start, data, ends in _chunks(batches):
        if (file, start) != at:
            at, sums, odd = (file, start), [_Sum(False), _Sum(True)], False
        for s in sums:
            s.feed(data)
        if ends:
            row = {"file": file, "start": start, "odd": sums[0].inside}
            for h, s in enumerate(sums):
                row |= {f"change{h}": s.depth, f"least{h}": s.least, f"keys{h}": [(d, k) for d, k in s.keys.items() if k is not None and d <= s.least + 2]}
            rows.append(row)
    if rows:
        types = {"file": pa.string(), "start": pa.int64(), "odd": pa.bool_()} | {f"{n}{h}": t for h in (0, 1) for n, t in (("change", pa.int32()), ("least", pa.int32()), ("keys", pa.map_(pa.int32(), pa.string())))}
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in types.items()], list(types))


def _beginnings(rows: list) -> dict[tuple[str, int], tuple[bool, int, str | None, int]]:
    """(file, start) -> inside a string, depth, the document's last key, the range in which an open item began."""
    out, file = {}, None
    for r in sorted(rows, key=lambda r: (r.file, r.start)):
        if r.file != file:
            if file is not None:
                _must_end(file, inside, depth)
            file, inside, depth, key, begun = r.file, False, 0, None, r.start
        out[r.file, r.start] = inside, depth, key, begun
        change, least, keys = (r.change1, r.least1, r.keys1) if inside else (r.change0, r.least0, r.keys0)
        key = keys.get(1 - depth, key)
        begun = begun if depth + least >= ITEM else r.start
        inside, depth = inside ^ r.odd, depth + change
    if file is not None:
        _must_end(file, inside, depth)
    return out


def _must_end(file: str, inside: bool, depth: int) -> None:
    # text after the last bracket, if only a line feed, counts as one more piece that a bracket ends
    if inside or depth not in (0, -1):
        raise ValueError(f"{file} ends inside a value")


class _Items:
    """Cuts items out of a range whose beginning is known."""

    def __init__(self, place: tuple[str, int], beginning: tuple[bool, int, str | None, int], names: frozenset[str]):
        (self.file, self.range), (self.inside, self.depth, self.key, self.begun) = place, beginning
        self.names, self.nth, self.open, self.held, self.rows = names, 0, self.depth >= ITEM, [], []
        self.begun = self.begun if self.open else self.range

    def _close(self, whole: bytes) -> None:
        if self.key in self.names:
            complete = self.begun == self.range
            self.rows.append((self.file, self.range, self.nth, self.key if complete else None, self.begun, None if complete else self.range, whole.decode("utf-8", "replace")))
        self.nth += 1
        self.open, self.held = False, []

    def feed(self, data: bytes) -> None:
        places, steps, colons, quotes, inside = _marks(data, self.inside)
        depth = self.depth + np.cumsum(steps)
        turns = []
        if len(places):
            kind = np.frombuffer(data, np.uint8)[places]
            begins = places[(steps > 0) & (depth == ITEM) & (kind == 123)]
            finish = places[(steps < 0) & (depth == ITEM - 1)]
            turns = sorted([(int(p), 0) for p in begins] + [(int(p), 1) for p in finish])
        if len(colons):
            at = np.searchsorted(places, colons)
            of = np.where(at > 0, depth[np.maximum(at - 1, 0)] if len(depth) else self.depth, self.depth)
            turns = sorted(turns + [(int(c), 2) for c in colons[of == 1]])
        start = 0
        for p, what in turns:
            if what == 2:
                self.key = _key_before(data, p, quotes) or self.key
            elif what == 0:
                self.open, self.begun, start, self.held = True, self.range, p, []
            elif self.open:
                self._close(b"".join([*self.held, data[start : p + 1]]))
        if self.open:
            self.held.append(data[start:])
        self.inside, self.depth = inside, int(depth[-1]) if len(depth) else self.depth

    def end(self) -> list[tuple]:
        """All rows; what is still open goes on in the next range."""
        if self.open and self.key in self.names:
            fresh = self.begun == self.range
            self.rows.append((self.file, self.range, self.nth, self.key if fresh else None, self.begun, self.range, b"".join(self.held).decode("utf-8", "replace")))
        return self.rows


def array_items(spark: SparkSession, path: str, *names: str) -> DataFrame:
    """name, file, range, nth, body: the objects of the named top-level arrays of the JSON documents at a path. (file, range,
    nth) is their order: by the path of the file, then by place in it."""
    lines = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("value"))
    begins = _beginnings(lines.mapInArrow(_summaries, _SUMMARY).collect())  # a row for each range, as many as the scan has tasks
    known = spark.sparkContext.broadcast(begins)

    def cut(batches, wanted=frozenset(names)):
        items, at = None, None
        for file, start, data, ends in _chunks(batches):
            if (file, start) != at:
                at = file, start
                items = _Items(at, known.value[at], wanted)
            items.feed(data)
            if ends:
                items.end()
            if items.rows:
                columns = list(zip(*items.rows))
                items.rows = []
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))], [c.split()[0] for c in _ITEMS.split(", ")])

    rows = lines.mapInArrow(cut, _ITEMS)
    order = ["name", "file", "range", "nth", "body"]
    whole = rows.where("part is null").select(order)
    parts = rows.where("part is not null").groupBy("file", "begun").agg(F.max("name").alias("name"), F.max(F.when(F.col("part") == F.col("begun"), F.col("nth"))).alias("nth"), F.array_sort(F.collect_list(F.struct("part", "body"))).alias("parts"))
    joined = parts.select("name", "file", F.col("begun").alias("range"), "nth", F.array_join(F.transform("parts", lambda p: p["body"]), "").alias("body"))
    return whole.unionByName(joined.where("name is not null"))
