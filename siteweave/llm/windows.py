"""Near-duplicate passages by compact windows over min-hashes.

A text is a row of five-word shingles. Under one hash function the runs of ``RUN`` shingles (50
words) whose least hash stands at place c begin in one interval: a compact window. It is read off
the Cartesian tree of the hashes; of the tree only nodes that cover ``RUN`` shingles or more
matter, and these are the minimisers, so the tree is built over them alone, by array steps.
For each pair of functions of ``COVER``, runs in a row with the same least hashes under both are a
segment. Segments with the same shingles are one class: held by two texts, all its runs are near
passages. Classes that agree in both functions meet (so any two runs that agree in 3 of 5 do), and
every two of such a group are compared by the exact Jaccard similarity of the runs' shingle sets,
first run by run as their least hashes lie, then at any other places, until they have a run in common and
each run that any other class verifies has one that does. Groups over ``BLOCK`` are cut into blocks,
each two of which meet in a task of their own.

Two texts are linked if they hold one class or classes that have a run in common. Links are sets of text
numbers, a class's or a text's, and are united by tasks; only their numbers are returned.

A pair of similarity 0.8 agrees in 3 of 5 hashes with probability 0.94, at 0.9 with 0.99, and
passages longer than 50 words have many runs; reported passages are always verified.

Defined edge cases: null texts and texts under 50 words have no passage; a text that occurs
twice (also as a repeated row) is one passage; null keys are kept and their texts compared as any
others; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from siteweave.llm.passages import _powers_up_to, _sliding, gram_hashes, minimisers, mixed, word_hashes, words_of
from siteweave.plans.store import discard, written

SHINGLE, WORDS = 5, 50
RUN = WORDS - SHINGLE + 1
HASHES = 5
#: Of any three of the five functions two are a pair of these.
COVER = ((0, 1), (2, 3), (2, 4), (3, 4))
SIMILARITY = 0.8
#: Shingles that runs of SIMILARITY have in one of them only, at most.
APART = int(2 * RUN * (1 - SIMILARITY) / (1 + SIMILARITY) + 1e-9)
#: Texts that a task remembers so that copies it has seen send no second row.
SEEN = 500_000
#: Members of a group that one task compares; a larger group is cut.
BLOCK = 8192
#: Words that one array step takes together.
AT_ONCE = 200_000
#: Passes over the groups.
PARTS = 3
#: Shingles that runs of SIMILARITY have in common, at least, if they have none twice.
LEAST = RUN - APART // 2
#: Members of a slot from which on its pairs are compared by squares.
FEW = 64
#: Pairs of runs that are told apart one by one, rather than all of two members at once.
ONE_BY_ONE = 24
#: Pairs that one array step compares place by place, and numbers that it compares in all places.
PAIRS, CELLS = 4096, 2_000_000
#: Members of a slot that one array step compares with as many others.
TILE = 64
#: Links that one row has at most; more take several rows.
LINKS = 1024
_SEEDS = mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def compact_windows(x: np.ndarray, run: int, begin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(c, first, last): the runs that begin at first .. last have their (leftmost) least number at c.

    ``begin``: where each of several texts in a row begins; no run crosses to the next."""
    at = minimisers(x, run)
    values, n = x[at], len(x)
    left, right = np.full(len(at), -1), np.full(len(at), n)
    # the Cartesian tree: nearest smaller numbers on both sides, of all nodes at once; those out of a run's reach don't matter
    for found, way in ((left, -1), (right, 1)):
        i, step = np.arange(len(at)), way
        while len(i):
            i = i[(i + step >= 0) & (i + step < len(at))]
            i = i[np.abs(at[i] - at[i + step]) < run]
            smaller = values[i + step] <= values[i] if way < 0 else values[i + step] < values[i]
            found[i[smaller]] = at[i[smaller] + step]
            i, step = i[~smaller], step + way
    begin = np.zeros(1, dtype=np.int64) if begin is None else begin
    text = np.searchsorted(begin, at, "right") - 1
    end = np.append(begin[1:], n)[text]
    first, last = np.maximum(np.maximum(left + 1, at - run + 1), begin[text]), np.minimum(np.minimum(at, right - run), end - run)
    ok = first <= last
    return at[ok], first[ok], last[ok]


def shingled(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of texts of SHINGLE words or more in a row, and where those of each text begin."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    grams = gram_hashes(word_hashes([w for t in texts for w in t]), SHINGLE)
    inside = np.repeat(np.cumsum(size) - SHINGLE, size) >= np.arange(size.sum())
    count = size - SHINGLE + 1
    return grams[inside[: len(grams)]], np.cumsum(count) - count


def _least(grams: np.ndarray, begin: np.ndarray, shared: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For each function its compact windows in order: first and last run, place of the least hash, that hash, if it is shared."""
    out = []
    for seed in _SEEDS:
        x = mixed(grams ^ seed)
        c, first, last = compact_windows(x, RUN, begin)  # leftmost least places never go back, so runs are in order
        name = x[c].view(np.int64)
        out.append((first, last, c, name, np.isin(name, shared)))
    return out


def _together(batches, column: int):
    """Lists of (batch, row, words) of about AT_ONCE words together, so that one array step serves many texts."""
    waiting, size = [], 0
    for b in batches:
        for i, t in enumerate(b.column(column).cast(pa.binary())):
            words = words_of(t.as_py())
            waiting.append((b, i, words))
            size += len(words) + 1
            if size >= AT_ONCE:
                yield waiting
                waiting, size = [], 0
    if waiting:
        yield waiting


def _names(base: DataFrame, key: str) -> DataFrame:
    """base (key, th, text) -> key, th, n_words, names: the least hashes of each text."""
    kind = base.schema[key].dataType

    def run(batches):
        seen: set[int] = set()
        for rows in _together(batches, 2):
            ids = pa.concat_arrays([b.column(0).slice(i, 1) for b, i, _ in rows])
            th = [b.column(1)[i].as_py() for b, i, _ in rows]
            new = []
            for i, (_, _, words) in enumerate(rows):
                if len(words) >= WORDS and th[i] not in seen:
                    seen.add(th[i])
                    new.append(i)
            names = [None] * len(rows)
            if new:
                grams, begin = shingled([rows[i][2] for i in new])
                found = []
                for seed in _SEEDS:
                    x = mixed(grams ^ seed)
                    c = compact_windows(x, RUN, begin)[0]
                    found.append((np.searchsorted(begin, c, "right") - 1, x[c]))
                text, name = np.concatenate([t for t, _ in found]), np.concatenate([n for _, n in found])
                order = np.lexsort((name, text))
                text, name = text[order], name[order]
                use = np.concatenate([[True], (np.diff(text) != 0) | (name[1:] != name[:-1])])
                text, name = text[use], name[use].view(np.int64)
                for i, found in zip(new, np.split(name, np.searchsorted(text, np.arange(1, len(new))))):
                    names[i] = found
            count = pa.array([len(words) for _, _, words in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(th, pa.int64()), count, pa.array(names, pa.list_(pa.int64()))], [key, "th", "n_words", "names"])
            if len(seen) > SEEN:
                seen.clear()

    schema = StructType([StructField(key, kind), StructField("th", LongType()), StructField("n_words", LongType()), StructField("names", ArrayType(LongType()))])
    return base.mapInArrow(run, schema)


def segments(grams: np.ndarray, begin: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start, n, class, key, anchor): the n runs from start on have the same least hashes of a pair of ``COVER``.

    A class is all that the segment's runs hold, for this pair; an anchor is the place of the first of the two
    hashes, from start on. Only segments of which both hashes are shared are given."""
    windows = _least(grams, begin, shared)
    up, down = _powers_up_to(len(grams) + 1)
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed(grams) * up[: len(grams)], dtype=np.uint64)])
    out = []
    for i, (f, g) in enumerate(COVER):
        (first, last, place, name, known), (first2, last2, _, name2, known2) = windows[f], windows[g]
        at = np.union1d(first, first2)  # a segment ends where a window of either function does
        w, w2 = np.searchsorted(first, at, "right") - 1, np.searchsorted(first2, at, "right") - 1
        use = known[w] & known2[w2]
        at, w, w2 = at[use], w[use], w2[use]
        n = np.minimum(last[w], last2[w2]) - at + 1
        key = mixed(mixed(name[w].view(np.uint64) + np.uint64(i)) ^ name2[w2].view(np.uint64))
        held = mixed(((total[at + n + RUN - 1] - total[at]) * down[at] + n.astype(np.uint64)) ^ mixed(key))
        text = np.searchsorted(begin, at, "right") - 1
        out.append((text, at - begin[text], n, held.view(np.int64), key.view(np.int64), place[w] - at))
    return tuple(np.concatenate(c) for c in zip(*out))


def _segments(texts: DataFrame) -> DataFrame:
    """texts (th, text, shared names, num) -> cls, th, start, n, key, anchor, num."""

    def run(batches):
        seen: set[int] = set()
        for rows in _together(batches, 1):
            new = []
            for b, i, words in rows:
                if (th := b.column(0)[i].as_py()) not in seen:
                    seen.add(th)
                    new.append((th, words, b.column(2)[i].values.to_numpy(), b.column(3)[i].as_py()))
            if new:
                shared = np.unique(np.concatenate([x for _, _, x, _ in new]))
                text, start, n, cls, key, anchor = segments(*shingled([w for _, w, _, _ in new]), shared)
                th, num = np.array([t for t, _, _, _ in new], dtype=np.int64)[text], np.array([x for *_, x in new], dtype=np.int64)[text]
                for i in range(0, len(start), 50_000):
                    j = slice(i, i + 50_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cls[j]), pa.array(th[j]), pa.array(start[j].astype(np.int32)), pa.array(n[j].astype(np.int32)), pa.array(key[j]), pa.array(anchor[j].astype(np.int32)), pa.array(num[j])],
                        ["cls", "th", "start", "n", "key", "anchor", "num"],
                    )
            if len(seen) > SEEN:
                seen.clear()

    return texts.mapInArrow(run, "cls bigint, th bigint, start int, n int, key bigint, anchor int, num bigint")


#: ``texts``: numbers of a class's texts, if there are several; else ``num`` is the text's.
_MEMBER = "slot bigint, side int, cls bigint, low bigint, high bigint, anchor int, num bigint, texts array<bigint>"


def _rows(texts: DataFrame) -> DataFrame:
    """texts (th, text, asked (members, start, n)) -> members with row: the shingle hashes of each."""
    fields = [f.split()[0] for f in _MEMBER.split(", ")]

    def run(batches):
        seen: set[int] = set()
        for rows in _together(batches, 1):
            new = []
            for b, i, words in rows:
                if (th := b.column(0)[i].as_py()) not in seen:
                    seen.add(th)
                    new.append((words, b.column(2)[i].values))
            if new:
                grams, begin = shingled([w for w, _ in new])
                short = (grams >> np.uint64(32)).astype(np.uint32)
                asked = pa.concat_arrays([a for _, a in new])
                at = asked.field("start").to_numpy() + np.repeat(begin, [len(a) for _, a in new])
                end = at + asked.field("n").to_numpy() + RUN - 1
                for i in range(0, len(at), 5_000):
                    row = pa.array([short[x:y].tobytes() for x, y in zip(at[i : i + 5_000].tolist(), end[i : i + 5_000].tolist())], pa.binary())
                    yield pa.RecordBatch.from_arrays([*[asked.field(f).slice(i, 5_000) for f in fields], row], [*fields, "row"])
            if len(seen) > SEEN:
                seen.clear()

    return texts.mapInArrow(run, f"{_MEMBER}, row binary")


def jaccard(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Similarity of the sets in each row of x and y."""
    whole = distinct(np.concatenate([x, y], axis=1))
    return (distinct(x) + distinct(y) - whole) / whole


def distinct(x: np.ndarray) -> np.ndarray:
    """How many different numbers each row of x has."""
    return 1 + (np.diff(np.sort(x, axis=1), axis=1) != 0).sum(axis=1)


def _bits(flat: np.ndarray) -> np.ndarray:
    """Of 256 bits the one that each number sets, in four rows."""
    bits = np.zeros((4, len(flat)), dtype=np.uint64)
    bits[(flat >> np.uint32(6)) & np.uint32(3), np.arange(len(flat))] = np.uint64(1) << (flat & np.uint32(63)).astype(np.uint64)
    return bits


def signatures(flat: np.ndarray) -> np.ndarray:
    """256 bits for each run of RUN numbers in a row, of which each number sets one."""
    return np.stack([_sliding(np.bitwise_or, b, RUN) for b in _bits(flat)], axis=1)


def _each(times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """0 .. times - 1 for each row: the row's index and the number."""
    row = np.repeat(np.arange(len(times)), times)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)


def _runs(places: np.ndarray) -> np.ndarray:
    """How many of each run's places, along the first axis, are set; or sums of small numbers."""
    places = places.view(np.uint8)
    out = np.empty((len(places) - RUN + 1, *places.shape[1:]), dtype=np.uint8)
    np.add.reduce(places[:RUN], axis=0, dtype=np.uint8, out=out[0])
    for k in range(1, len(out)):
        np.add(out[k - 1], places[k + RUN - 1], out=out[k])
        out[k] -= places[k - 1]
    return out


class _Slot:
    """The members of one large slot, laid side by side with their least hashes in one line.

    ``names`` has a row for each place and a column for each member: numbers of shingles, 0 for those that one member alone has
    and where there is none. Pairs are compared by squares of TILE members, a row of them for each place."""

    def __init__(self, flat: np.ndarray, size: np.ndarray, lift: np.ndarray, deep: int, twice: np.ndarray, firsts):
        """firsts: (member, row, place) of some members: the place has a shingle of the run that begins in the row, and no earlier one has it."""
        many = len(size)
        self.firsts = firsts
        m, k = _each(size)
        known, number = np.unique(flat, return_inverse=True)
        held = np.unique(number * many + m)
        holders = np.bincount(held // many, minlength=len(known))
        numbers = np.where(holders > 1, np.cumsum(holders > 1), 0)
        held = held[holders[held // many] > 1]
        self.held, self.holder = numbers[held // many], held % many
        order = np.argsort(self.holder, kind="stable")
        self.held, self.holder = self.held[order], self.holder[order]
        self.last, self.twice = int(numbers.max(initial=0)), twice
        self.names = np.zeros((deep, many), dtype=np.int32)
        self.names[k + lift[m], m] = numbers[number]
        self.others = np.where(self.names == 0, self.last + 1, self.names)  # these never equal a 0
        #: how many different shingles each run has, by the row that it begins in; 0: there is no such run
        several = np.zeros((deep - RUN + 1, many), dtype=np.int64)
        m, k = _each(size - RUN + 1)
        several[k + lift[m], m] = RUN
        again = np.flatnonzero(twice)
        for q in range(0, len(again), TILE):
            several[:, again[q : q + TILE]] = firsts(again[q : q + TILE]).sum(axis=2).T
        there = several > 0
        # runs with so many places alike have the similarity, whichever shingles these are
        self.enough = np.where(there, RUN - several // 9, 255).astype(np.uint8)
        # runs of the similarity hold so many shingles of the other's member, at least
        few = int(several[there].min(initial=RUN))
        self.needed = np.where(there, np.maximum(-(-4 * several // 5), -(-4 * (several + few) // 9)), 255).astype(np.uint8)

    def clean(self, i: slice, j: slice) -> np.ndarray:
        """(member of i, member of j): neither has a shingle twice."""
        return ~self.twice[i, None] & ~self.twice[None, j]

    def same(self, i: slice, j: slice) -> np.ndarray:
        """(place, member of i, member of j): the shingles that stand there are the same."""
        return self.names[:, i, None] == self.others[:, None, j]

    def in_line(self, i: slice, j: slice) -> tuple[np.ndarray, np.ndarray]:
        """(row, member of i, member of j): the run of i's member, or of j's, that begins in this row is alike with one of the other as
        the places stand: the one that lies as it does or, of members without a shingle twice, the nearest."""
        same, clean = _runs(self.same(i, j)), self.clean(i, j)
        one, two = same >= self.enough[:, i, None], same >= self.enough[:, None, j]
        return one & (clean | two), two & (clean | one)

    def elsewhere(self, i: slice, j: slice, same: np.ndarray) -> np.ndarray:
        """(row, member of i, member of j): the run of i's member may be alike with some run of j's that ``in_line`` doesn't tell.

        It holds enough shingles of the other's member and, if neither member has one twice, some of them in other places: if
        all stand in line, no run of the other is better than the one that lies as it does, or the nearest."""
        a, b = np.searchsorted(self.holder, [j.start, j.stop])
        number = np.unique(self.held[a:b])
        has = np.zeros((len(number) + 1, j.stop - j.start), dtype=bool)
        has[np.searchsorted(number, self.held[a:b]) + 1, self.holder[a:b] - j.start] = True
        row = np.zeros(self.last + 1, dtype=np.int64)
        row[number] = np.arange(1, len(number) + 1)
        has = has[row[self.names[:, i]]]
        held = _runs(has)
        again = np.flatnonzero(self.twice[i] & (held >= self.needed[:, i, None]).any(axis=(0, 2)))
        if len(again):
            held[:, again] = np.matmul(self.firsts(i.start + again).astype(np.float32), has[:, again].transpose(1, 0, 2).astype(np.float32, order="C")).transpose(1, 0, 2)
        found = held >= self.needed[:, i, None]
        if found.any():
            found &= (_runs(has & ~same) > 0) | ~self.clean(i, j)
        return found


def compared(slot: np.ndarray, side: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, rows: list[bytes]):
    """Rows sorted by slot -> (member, start, other), starts of members that a run of another verifies, and bits.

    In each slot every two members are compared; bit k of a member's row is set if it has a run alike with one of the slot's
    k-th member, at any places. ``low`` and ``high`` are the least and greatest text of a member's class. A member of
    several texts is verified by itself. Of a slot with side >= 0 only members of unlike sides meet.

    Runs are compared in line first, then in all places: by counts of equal places, or of different shingles where a member has one twice."""
    size = np.array([len(r) // 4 for r in rows], dtype=np.int64)
    at, flat = np.cumsum(size) - size, np.frombuffer(b"".join(rows), dtype=np.uint32)
    signature, run = signatures(flat), np.arange(RUN)[None, :]
    several = np.zeros(len(signature), dtype=np.int64)  # different shingles of a run, once it was asked for
    n = size - RUN + 1
    begin = np.cumsum(n) - n  # of each member's starts
    # bits of any of a member's runs, and of all of them
    inside = np.bitwise_or.reduceat(_bits(flat), at, axis=1).T if len(at) else np.zeros((0, 4), dtype=np.uint64)
    core = np.bitwise_and.reduceat(signature[np.repeat(at - begin, n) + np.arange(n.sum())], begin) if len(at) else inside
    head = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]])[: len(slot)])
    members = np.diff(np.append(head, len(slot)))
    first, many = np.repeat(head, members), np.repeat(members, members)
    here = np.arange(len(slot))
    bits = np.zeros((len(slot), -(-int(members.max(initial=0)) // 8)), dtype=np.uint8)
    out = []
    alone = lambda x, y: np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64)

    # a column for each member, the least hashes in one line: shingles, or 0 and 1 where there is none
    lift = int(anchor.max(initial=0)) - anchor
    deep = int((size + lift).max(initial=RUN))
    shown = flat if flat.min(initial=2) > 1 else (np.unique(flat, return_inverse=True)[1] + 2).astype(np.uint32)
    line = np.zeros((deep, len(slot)), dtype=np.uint32)
    m, k = _each(size)
    line[k + lift[m], m] = shown
    others = np.maximum(line, 1)
    there = np.zeros((deep - RUN + 1, len(slot)), dtype=bool)  # rows in which a member's runs begin
    m, k = _each(n)
    there[k + lift[m], m] = True
    open_ = there & (low == high)  # of runs that nothing verified yet
    in_order = np.sort(line, axis=0)
    twice = ((in_order[1:] == in_order[:-1]) & (in_order[1:] > 0)).any(axis=0)
    again = np.flatnonzero(twice)
    earlier = np.full((deep, len(again)), -1, dtype=np.int16)  # the place before with the same shingle
    order = np.argsort(line[:, again], axis=0, kind="stable")
    in_order = np.take_along_axis(line[:, again], order, axis=0)
    k, m = np.nonzero((in_order[1:] == in_order[:-1]) & (in_order[1:] > 0))
    earlier[order[k + 1, m], m] = order[k, m]
    places, starts = np.arange(deep)[None, None], np.arange(deep - RUN + 1)[None, :, None]
    within = (places >= starts) & (places < starts + RUN)

    def firsts(m):
        """(member, row, place): a shingle of the run that begins in this row stands there and at no earlier place of the run."""
        new = within & there[:, m].T[:, :, None]
        own = np.flatnonzero(twice[m])
        new[own] &= earlier[:, np.searchsorted(again, m[own])].T[:, None] < starts
        return new

    def may(a, b):
        return ((side[a] < 0) | (side[a] != side[b])) & ((low[a] != high[b]) | (high[a] != low[b]))

    def alike(x, s, y, t):
        """Which runs, at s of member x and at t of y, have the similarity."""
        a, b, found = at[x] + s, at[y] + t, np.zeros(len(x), dtype=bool)
        for q in range(0, len(a), 20_000):
            u, v = a[q : q + 20_000], b[q : q + 20_000]
            # each bit of one signature alone is a shingle of one run alone
            close = np.flatnonzero(np.bitwise_count(signature[u] ^ signature[v]).sum(axis=1, dtype=np.int64) <= APART)
            u, v = u[close], v[close]
            new = np.unique(u[several[u] == 0])
            several[new] = distinct(flat[new[:, None] + run])
            x_, y_ = flat[u[:, None] + run], flat[v[:, None] + run]
            other = (x_ != y_).sum(axis=1)  # places that differ: each run alone has so many shingles at most
            ok = (several[u] - other) / (several[u] + other) >= SIMILARITY
            rest = np.flatnonzero(~ok)
            ok[rest] = jaccard(x_[rest], y_[rest]) >= SIMILARITY
            found[q + close] = ok
        return found

    def note(row, m, other):
        """Open runs of members, by the rows they begin in, that are alike with one of another."""
        new = np.flatnonzero(open_[row, m])
        new = new[np.unique(row[new] * len(slot) + m[new], return_index=True)[1]]
        row, m, other = row[new], m[new], other[new]
        open_[row, m] = False
        out.append(np.stack([m, row - lift[m], other]))

    def link(i, j):
        """Pairs of members of one slot, each once."""
        for x, y in ((i, j), (j, i)):
            place = y - first[y]
            np.bitwise_or.at(bits, (x, place >> 3), (128 >> (place & 7)).astype(np.uint8))

    def anywhere(a, b, linked):
        """All runs of members a with all of b, pair by pair. linked: pairs that are, of which only open runs count."""
        step = max(1, CELLS // deep**2)
        for use in (~twice[a] & ~twice[b], twice[a] | twice[b]):
            use = np.flatnonzero(use)
            for q in range(0, len(use), step):
                p = use[q : q + step]
                p = p[~linked[p] | open_[:, a[p]].any(axis=0) | open_[:, b[p]].any(axis=0)]
                i, j = a[p], b[p]
                common = _runs((line[:, i][:, None] == others[:, j][None]).transpose(1, 0, 2))  # by runs of j, then by places of i
                if twice[i].any() or twice[j].any():
                    one, two = firsts(i), firsts(j)
                    common = np.matmul(one.astype(np.float32), (common > 0).transpose(2, 1, 0).astype(np.float32, order="C"))
                    whole = one.sum(axis=2)[:, :, None] + two.sum(axis=2)[:, None, :] - common
                    found = (common / np.maximum(whole, 1) >= SIMILARITY).transpose(2, 1, 0)
                else:
                    found = _runs(common.transpose(1, 0, 2)).transpose(1, 0, 2) >= LEAST
                found &= there[:, j][:, None] & there[:, i][None]
                one, two = found.any(axis=0), found.any(axis=1)
                met = one.any(axis=0)
                link(i[met], j[met])
                for mine, x, y in ((one, i, j), (two, j, i)):
                    row, p = np.nonzero(mine & open_[:, x])
                    note(row, x[p], y[p])

    def elsewhere(i, j, shift, linked, pairs, whole):
        """Runs of i, open ones or (``whole``) all, with all of j that don't lie as the least hashes do."""
        for k in range(0, len(pairs), 4096):
            p, s = _each(n[i[pairs[k : k + 4096]]])
            p = pairs[k : k + 4096][p]
            use = whole[p] | open_[s + lift[i[p]], i[p]]
            p, s = p[use], s[use]
            # what is nowhere in the other member is in this run alone, what all the other's runs have is in that one alone
            mine = signature[at[i[p]] + s]
            near = alone(mine, inside[j[p]]) + alone(core[j[p]], mine) <= APART
            p, s = p[near], s[near]
            for q in range(0, len(p), 4096):
                r, t = _each(n[j[p[q : q + 4096]]])
                pr, sr = p[q : q + 4096][r], s[q : q + 4096][r]
                use = t != sr + shift[pr]
                pr, sr, t = pr[use], sr[use], t[use]
                ok = alike(i[pr], sr, j[pr], t)
                noted(i[pr[ok]], sr[ok], j[pr[ok]], t[ok])
                linked[pr[ok]] = True

    def noted(x, s, y, t):
        note(s + lift[x], x, y)
        note(t + lift[y], y, x)

    def large(h, many):
        """All pairs of the slot whose members are h .. h + many - 1."""
        of = _Slot(flat[at[h] : at[h] + size[h : h + many].sum()], size[h : h + many], lift[h : h + many], deep, twice[h : h + many], lambda m: firsts(h + m))
        squares = [(slice(i, min(i + TILE, many)), slice(j, min(j + TILE, many))) for i in range(0, many, TILE) for j in range(i, many, TILE)]
        members_ = lambda i: np.arange(h + i.start, h + i.stop)

        def allowed(i, j):
            a, b = members_(i)[:, None], members_(j)[None, :]
            return (a < b) & may(a, b)

        def square(i, j, new):
            for x, y, found in ((i, j, new), (j, i, new.T)):
                byte = np.packbits(found, axis=1)
                bits[h + x.start : h + x.stop, y.start >> 3 : (y.start >> 3) + byte.shape[1]] |= byte

        def meet(i, j, one, two):
            """Runs of ``one`` with those of ``two``, (row, member of i, member of j) each."""
            x, y = np.nonzero(one.any(axis=0) & two.any(axis=0))
            runs, theirs = one.transpose(1, 2, 0)[x, y], two.transpose(1, 2, 0)[x, y]
            part = np.cumsum(np.count_nonzero(runs, axis=1) * np.count_nonzero(theirs, axis=1)) // 200_000
            for p in np.split(np.arange(len(x)), np.flatnonzero(np.diff(part)) + 1) if len(x) else []:
                a, s = np.nonzero(runs[p])
                b, t = np.nonzero(theirs[p])
                times = np.bincount(b, minlength=len(p))
                r, q = _each(times[a])
                q += (np.cumsum(times) - times)[a[r]]
                a, s, t = a[r], s[r], t[q]
                k, m = h + i.start + x[p][a], h + j.start + y[p][a]
                ok = np.flatnonzero(alike(k, s - lift[k], m, t - lift[m]))
                k, s, m, t = k[ok], s[ok], m[ok], t[ok]
                new = np.zeros(one.shape[1:], dtype=bool)
                new[k - h - i.start, m - h - j.start] = True
                square(i, j, new)
                note(s, k, m)
                note(t, m, k)

        for i, j in squares:
            pairs = allowed(i, j)
            one, two = of.in_line(i, j)
            one &= pairs
            two &= pairs
            square(i, j, one.any(axis=0) | two.any(axis=0))
            for x, y, mine in ((i, j, one), (j, i, two.transpose(0, 2, 1))):
                row, k = np.nonzero(open_[:, members_(x)] & mine.any(axis=2))
                note(row, h + x.start + k, h + y.start + mine[row, k].argmax(axis=1))
        for i, j in squares:
            linked = np.unpackbits(bits[h + i.start : h + i.stop, j.start >> 3 : (j.stop + 7) >> 3], axis=1, count=j.stop - j.start).view(bool)
            mine, theirs = open_[:, members_(i), None], open_[:, None, members_(j)]
            wanted = allowed(i, j) & (~linked | mine.any(axis=0) | theirs.any(axis=0))
            if not wanted.any():
                continue
            same = of.same(i, j)
            one = of.elsewhere(i, j, same)
            wanted &= one.any(axis=0)
            if not wanted.any():
                continue
            two = of.elsewhere(j, i, same.transpose(0, 2, 1)).transpose(0, 2, 1)
            # all runs of pairs that aren't linked yet, open ones of others
            wanted &= two.any(axis=0) & (~linked | (one & mine).any(axis=0) | (two & theirs).any(axis=0))
            # a few runs of members with a shingle twice are compared one by one
            few = ~of.clean(i, j) & wanted
            if few.any():
                mine, theirs = open_[:, members_(i), None], open_[:, None, members_(j)]
                ones, twos = one.sum(axis=0), two.sum(axis=0)
                few &= np.where(linked, (one & mine).sum(axis=0) * twos + ones * (two & theirs).sum(axis=0), ones * twos) <= ONE_BY_ONE
                meet(i, j, one & (few & ~linked), two)
                meet(i, j, one & open_[:, members_(i), None] & (few & linked), two)
                meet(i, j, one & (few & linked), two & open_[:, None, members_(j)])
            x, y = np.nonzero(wanted & ~few)
            anywhere(h + i.start + x, h + j.start + y, linked[x, y])

    for h, m in zip(head[members >= FEW].tolist(), members[members >= FEW].tolist()):
        large(h, m)
    many = np.where(many >= FEW, 0, many)
    # pairs of small slots: first in line
    a, k = _each(np.maximum(many - 1 - (here - first), 0))
    b = a + 1 + k
    use = may(a, b) & ~twice[a] & ~twice[b]
    use &= alone(core[a], inside[b]) + alone(core[b], inside[a]) <= APART  # of others no two runs are alike
    a, b = a[use], b[use]
    linked = np.zeros(len(a), dtype=bool)
    for q in range(0, len(a), PAIRS):
        i, j = a[q : q + PAIRS], b[q : q + PAIRS]
        same = _runs(line[:, i] == others[:, j]) >= LEAST
        one, two = same & there[:, i], same & there[:, j]
        linked[q : q + PAIRS] = one.any(axis=0) | two.any(axis=0)
        for mine, x, y in ((one, i, j), (two, j, i)):
            row, p = np.nonzero(mine & open_[:, x])
            note(row, x[p], y[p])
    link(a[linked], b[linked])
    use = ~linked | open_[:, a].any(axis=0) | open_[:, b].any(axis=0)
    anywhere(a[use], b[use], linked[use])
    # pairs with a member that has a shingle twice
    for r in range(1, int(many.max(initial=0)) // 2 + 1):
        live = here[many >= 2 * r]
        other = first[live] + (live - first[live] + r) % many[live]
        use = (twice[live] | twice[other]) & may(live, other)
        live, other = live[use], other[use]
        near = alone(core[live], inside[other]) + alone(core[other], inside[live]) <= APART  # of others no two runs are alike
        live, other = live[near], other[near]
        for k in range(0, len(live), 4096):
            i, j = live[k : k + 4096], other[k : k + 4096]
            shift = anchor[j] - anchor[i]
            lo, hi = np.maximum(0, -shift), np.minimum(n[i], n[j] - shift)
            linked, meet = np.zeros(len(i), dtype=bool), np.flatnonzero(hi > lo)
            mid = (lo + hi)[meet] // 2
            linked[meet] = alike(i[meet], mid, j[meet], mid + shift[meet])
            # all runs as the least hashes lie, where some are open
            missing = lambda m: open_[:, m].any(axis=0)
            pairs = np.flatnonzero(~linked | missing(i) | missing(j))
            p, s = _each(np.maximum(hi - lo, 0)[pairs])
            p = pairs[p]
            s = s + lo[p]
            t = s + shift[p]
            use = ~linked[p] | open_[s + lift[i[p]], i[p]] | open_[t + lift[j[p]], j[p]]
            p, s, t = p[use], s[use], t[use]
            ok = alike(i[p], s, j[p], t)
            noted(i[p[ok]], s[ok], j[p[ok]], t[ok])
            linked[p[ok]] = True
            whole = ~linked
            elsewhere(i, j, shift, linked, np.flatnonzero(whole | missing(i)), whole)
            elsewhere(j, i, -shift, linked, np.flatnonzero(~whole & missing(j)), np.zeros(len(i), dtype=bool))
            link(i[linked], j[linked])
    return np.concatenate(out, axis=1) if out else np.zeros((3, 0), dtype=np.int64), bits


def verified(slot: np.ndarray, side: np.ndarray, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, rows: list[bytes]):
    """The first result of ``compared``."""
    return compared(slot, side, low, high, anchor, rows)[0]


def _listed(owner: np.ndarray, num: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(owner, num) -> rows of an owner and its numbers in order, each once, as differences; LINKS in a row at most."""
    order = np.lexsort((num, owner))
    owner, num = owner[order], num[order]
    new = np.concatenate([[True], (np.diff(owner) != 0) | (np.diff(num) != 0)])[: len(owner)]
    owner, num = owner[new], num[new]
    start = np.flatnonzero(np.concatenate([[True], np.diff(owner) != 0])[: len(owner)])
    nth = np.arange(len(owner)) - np.repeat(start, np.diff(np.append(start, len(owner))))
    head = np.flatnonzero(nth % LINKS == 0)
    step = np.diff(num, prepend=0)
    step[head] = num[head]
    return owner[head], pa.ListArray.from_arrays(pa.array(np.append(head, len(num)).astype(np.int32)), pa.array(step))


def _numbers(links: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``_listed`` -> the row and the number of each link."""
    size, step = links.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), links.flatten().to_numpy()
    total, head = np.cumsum(step), np.cumsum(size) - size
    row = np.repeat(np.arange(len(size)), size)
    return row, total - (total[head[row]] - step[head[row]])


def _verified(batches):
    """Rows (slot, side, cls, low, high, anchor, num, texts, row) sorted by slot -> cls, at, n (n runs from at on are verified) and
    cls, num (null: the class has several texts), links (numbers of texts)."""

    def found(table):
        slot, side, cls, low, high, anchor = (table.column(i).to_numpy().astype(np.int64) for i in range(6))
        (m, at, _), bits = compared(slot, side, low, high, anchor, table.column(8).to_pylist())
        order = np.lexsort((at, m))
        m, at = m[order], at[order]
        head = np.flatnonzero(np.concatenate([[True], (np.diff(m) != 0) | (np.diff(at) != 1)])[: len(m)])
        n = np.diff(np.append(head, len(m)))
        empty = [pa.nulls(len(head), pa.int64()), pa.nulls(len(head), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([pa.array(cls[m[head]]), pa.array(at[head].astype(np.int32)), pa.array(n.astype(np.int32)), *empty], _FOUND)
        # each member's texts
        num, texts = table.column(6).to_numpy(), table.column(7).combine_chunks()
        own = low == high
        size = np.where(own, 1, pa.compute.coalesce(pa.compute.list_value_length(texts), 0).to_numpy())
        held = np.zeros(size.sum(), dtype=np.int64)
        begin = np.cumsum(size) - size
        held[np.repeat(own, size)] = num[own]
        held[np.repeat(~own, size)] = texts.filter(pa.array(~own)).flatten().to_numpy()
        head = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
        first = np.repeat(head, np.diff(np.append(head, len(slot))))
        linked = np.flatnonzero(bits.any(axis=1))
        # what a step lists is bounded, but for a single member's links
        upto = np.cumsum(np.bitwise_count(bits[linked]).sum(axis=1, dtype=np.int64) * int(size.max(initial=1))) // 2_000_000
        for part in np.split(linked, np.flatnonzero(np.diff(upto)) + 1):
            i, place = np.nonzero(np.unpackbits(bits[part], axis=1))
            j = first[part[i]] + place
            row, k = _each(size[j])
            i, links = _listed(part[i[row]], held[begin[j[row]] + k])
            empty = [pa.nulls(len(i), pa.int32())] * 2
            yield pa.RecordBatch.from_arrays([pa.array(cls[i]), *empty, pa.array(num[i], mask=~own[i]), links], _FOUND)

    waiting, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        waiting.append(b)
        size += b.num_rows
        if size < BLOCK:
            continue
        table = pa.Table.from_batches(waiting).combine_chunks()
        slot = table.column(0).to_numpy()
        whole = int(np.searchsorted(slot, slot[-1]))
        if whole:
            yield from found(table.slice(0, whole))
        waiting, size = table.slice(whole).to_batches(), len(slot) - whole
    if waiting:
        yield from found(pa.Table.from_batches(waiting))


_FOUND = ["cls", "at", "n", "num", "links"]


def _united(counted: bool):
    """Rows (key, links) sorted by key -> key, links, each once; counted: key, how many differ from it."""

    def run(batches):
        key = num = np.zeros(0, dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            row, new = _numbers(b.column(1))
            key, num = np.append(key, b.column(0).to_numpy()[row]), np.append(num, new)
            order = np.lexsort((num, key))
            key, num = key[order], num[order]
            new = np.concatenate([[True], (np.diff(key) != 0) | (np.diff(num) != 0)])[: len(key)]
            key, num = key[new], num[new]
            ready = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if ready:
                yield finished(key[:ready], num[:ready])
                key, num = key[ready:], num[ready:]
        if len(key):
            yield finished(key, num)

    def finished(key, num):
        if not counted:
            return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in _listed(key, num)], ["key", "links"])
        names, at = np.unique(key, return_index=True)
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.add.reduceat((key != num).astype(np.int64), at))], ["key", "n_links"])

    return run


def joined(th: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Indices of rows, sorted by th and start, that begin a new span: they don't touch what came before in their text."""
    text = np.cumsum(np.concatenate([[0], th[1:] != th[:-1]])) if len(th) else np.zeros(0, dtype=np.int64)
    lift = text * (int(end.max(initial=0)) + 1)  # a later text's numbers are all greater
    reached = np.maximum.accumulate(end + lift)
    return np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | ((start + lift)[1:] > reached[:-1])])[: len(th)])


def _spans(batches):
    """Rows (th, start, end, other) sorted by th and start -> th, covered, n_links, spans; of a text only its spans and links are held."""
    none = np.zeros(0, dtype=np.int64)
    th, start, end, linked, other = none, none, none, none, none  # spans so far and links so far

    def finished(upto):
        head = np.flatnonzero(np.concatenate([[True], th[1:] != th[:-1]])[: len(th)])
        text = th[head]
        covered = np.add.reduceat(end - start, head)
        names, links = np.unique(linked, return_counts=True)
        parts = np.char.add(np.char.add(start.astype(str), "-"), end.astype(str)).tolist()
        listed = [";".join(parts[a:b]) for a, b in zip(head, np.append(head[1:], len(th)))]
        out = [pa.array(text[:upto]), pa.array(covered[:upto]), pa.array(links[np.searchsorted(names, text)][:upto]), pa.array(listed[:upto], pa.string())]
        return pa.RecordBatch.from_arrays(out, ["th", "covered", "n_links", "spans"])

    for b in batches:
        if not b.num_rows:
            continue
        t, s, e, o = (b.column(i).to_numpy() for i in range(4))
        th, start, end = np.append(th, t), np.append(start, s), np.append(end, e)
        head = joined(th, start, end)
        th, start, end = th[head], start[head], np.maximum.reduceat(end, head)
        linked, other = np.append(linked, t), np.append(other, o)
        order = np.lexsort((other, linked))
        linked, other = linked[order], other[order]
        new = np.concatenate([[True], (linked[1:] != linked[:-1]) | (other[1:] != other[:-1])])
        linked, other = linked[new], other[new]
        if th[0] != th[-1]:
            yield finished(len(np.unique(th)) - 1)
            last, linked_last = th == th[-1], linked == th[-1]
            th, start, end, linked, other = th[last], start[last], end[last], linked[linked_last], other[linked_last]
    if len(th):
        yield finished(1)


def near_passages(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """key, n_words, n_near_words, class_id (least key of the rows with this text), n_links (other texts that it shares a
    near passage with), spans ("start-end" by words, ;-joined)."""
    base = docs.select(F.col(key), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("th"), F.col(text).alias("__text"))
    each = written(_names(base, key), "documents")
    units = each.groupBy("th").agg(F.min(key).alias("rep"), F.count("*").alias("copies"), F.first("n_words").alias("n_words"))
    reps = units.select(F.col("th").alias("__th"), "rep")

    def with_text(asked):
        """asked (__th, ...) with the text of each."""
        asked = asked.join(reps, "__th")
        return base.join(asked.hint("shuffle_hash"), base[key].eqNullSafe(F.col("rep")) & (F.col("th") == F.col("__th")))

    by_name = Window.partitionBy("name")
    names = each.select("th", F.explode("names").alias("name"))
    shared = names.select("name", "th", (F.min("th").over(by_name) < F.max("th").over(by_name)).alias("met")).where("met")
    # texts are numbered as they are written, so numbers of one partition lie close together
    shared = written(shared.groupBy(F.col("th").alias("__th")).agg(F.collect_set("name").alias("names")).withColumn("num", F.monotonically_increasing_id()), "names")
    parts = written(_segments(with_text(shared).select("th", "__text", "names", "num")), "segments")
    numbers = shared.select(F.col("__th").alias("th"), "num")
    # all segments of a class agree in n, key and anchor
    firsts = [F.first(c).alias(c) for c in ("th", "start", "n", "key", "anchor", "num")]
    classes = written(parts.groupBy("cls").agg(F.min("th").alias("low"), F.max("th").alias("high"), *firsts), "classes")
    held = written(parts.join(classes.where("low <> high").select("cls"), "cls").groupBy("cls").agg(F.collect_set("num").alias("texts")), "held")
    # groups in which classes of different texts meet
    groups = classes.groupBy("key").agg(F.count("*").alias("size"), F.min("low").alias("low"), F.max("high").alias("high")).where("size > 1 and low < high")
    groups = groups.select("key", F.ceil(F.col("size") / block).cast("int").alias("blocks"))
    members = classes.join(groups, "key").join(held, "cls", "left").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    # a group over ``block`` is cut; every two of its blocks meet in a slot of their own
    spread = members.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    slot = F.xxhash64("key", F.least("own", "with"), F.greatest("own", "with"))
    side = F.when(F.col("own") == F.col("with"), -1).otherwise((F.col("own") > F.col("with")).cast("int"))
    member = F.struct(slot.alias("slot"), side.alias("side"), "cls", "low", "high", "anchor", "num", "texts", "start", "n")
    found = []
    for i in range(PARTS):  # so that the disk holds the rows of a part of the groups at a time
        asked = spread.where(F.pmod("key", F.lit(PARTS)) == i).groupBy(F.col("th").alias("__th")).agg(F.collect_list(member).alias("asked"))
        rows = _rows(with_text(asked).select("th", "__text", "asked")).repartition("slot").sortWithinPartitions("slot", "cls")
        found.append(written(rows.mapInArrow(_verified, "cls bigint, at int, n int, num bigint, links array<bigint>"), "verified"))
    true = functools.reduce(DataFrame.union, found)

    # links of classes of several texts, then of texts
    united = lambda df, counted, schema: df.repartition("key").sortWithinPartitions("key").mapInArrow(_united(counted), schema)
    in_order = F.array_sort("texts")
    steps = F.transform(in_order, lambda x, i: F.when(i == 0, x).otherwise(x - F.get(in_order, i - 1)))
    of_classes = held.select(F.col("cls").alias("key"), steps.alias("links")).union(true.where("links is not null and num is null").select("cls", "links"))
    of_classes = united(of_classes, False, "key bigint, links array<bigint>").join(held, F.col("key") == F.col("cls"))
    of_texts = of_classes.select(F.explode("texts").alias("key"), "links").union(true.where("links is not null and num is not null").select("num", "links"))
    links = united(of_texts, True, "key bigint, n_links bigint").join(numbers, F.col("key") == F.col("num")).select("th", "n_links")

    # spans of words: n runs from a place on
    span = lambda at, n: (at.cast("long").alias("start"), (at + n + WORDS - 1).cast("long").alias("end"))
    same = parts.join(classes.where("low <> high").select("cls", "low", "high"), "cls")
    same = same.select("th", *span(F.col("start"), F.col("n")), F.lit(0).cast("long").alias("o"))
    near = parts.select("cls", "th", "start").join(true.where("at is not null").select("cls", "at", "n"), "cls")
    near = near.select("th", *span(F.col("start") + F.col("at"), F.col("n")), F.lit(0).cast("long").alias("o"))  # links are counted apart
    per = same.union(near).repartition("th").sortWithinPartitions("th", "start").mapInArrow(_spans, "th bigint, covered bigint, n_links bigint, spans string")
    copied = (F.col("copies") > 1) & (F.col("n_words") >= WORDS)
    per_text = units.join(per.drop("n_links"), "th", "left").join(links, "th", "left").select(
        "th",
        F.col("rep").alias("class_id"),
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("covered", F.lit(0))).cast("long").alias("n_near_words"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(copied, F.concat(F.lit("0-"), F.col("n_words").cast("string"))).otherwise(F.coalesce("spans", F.lit(""))).alias("spans"),
    )
    return each.join(per_text, "th").select(key, "n_words", "n_near_words", "class_id", "n_links", "spans")
