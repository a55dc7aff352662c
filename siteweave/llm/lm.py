"""Language-model scores by a weighted backoff automaton of order 3.

The model: states are histories (none, the start of a text, every word of the training texts, every
pair of them in a row). A state has an arc for each word seen after it in training; all other words
leave it by its failure arc, which goes to the history without its first word. With c for training
counts and K = ``CONCENTRATION``:

    P(w) = (c(w) + 0.5) / (N + 0.5 (V + 1))           (unseen words too)
    P(w | v) = (c(v w) + K P(w)) / (c(v) + K)
    P(w | u v) = (c(u v w) + K P(w | v)) / (c(u v) + K)

So the failure arc of a state h weighs K / (c(h) + K), and each state's probabilities sum to one.
Nothing is pruned: every n-gram of the training texts is in the model, at any size of the corpus.
A text is walked from left to right: the state is carried, failure arcs are followed until an arc
fits, and log10 weights are added up.

Counts are global, the automaton is local. Texts are numbered in shards of bounded size. Each shard
sends its distinct n-grams (64-bit hashes, sorted, with its own training counts) in parcels, one for
each range of hashes; a range adds up all its parcels and answers each with the sums in the parcel's
own order. A frequent n-gram is one number in a parcel, so no key is hot. Words and pairs go first; of
the triples only those are sent whose both pairs are in other shards too, as all others are counted
where they are. The texts' table is bucketed by shard, so answers come to the texts.

Defined edge cases: a null or empty text is its end alone; documents of the held-out fold are
only scored, a document with a null key is trained on; with nothing to learn from, the base formula
has N = V = 0 and all tokens are unseen; repeated rows count each time and are scored each time;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siteweave.plans.store import discard, new_path, written

#: Bytes of text of a shard, about (a longer text is a shard).
SHARD_BYTES = 6 << 20
#: Training and other tokens for each range of hashes, about.
RANGE_TOKENS = 2_000_000
FOLDS, HELD_OUT = 5, 1
CONCENTRATION = 8.0
#: Tokens of a lane: texts are cut into lanes that are walked side by side.
LANE = 512
_START = -0x5DEECE66D  # the hash that stands for the start of a text
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
WORD, PAIR, TRIPLE = 0, 1, 2


def encode(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Token numbers of all texts in a row (0 ends a text), tokens of each text, words by number - 1."""
    lists = pc.ascii_split_whitespace(pc.fill_null(pc.ascii_lower(texts), ""))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    ends = kept[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    coded = flat.filter(real).dictionary_encode()
    numbers = np.insert(coded.indices.to_numpy().astype(np.int32) + 1, ends[1:], 0)
    return numbers, np.diff(ends) + 1, coded.dictionary


def pack(numbers: np.ndarray) -> bytes:
    """Numbers, byte by byte of equal rank, compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()
    return pa.Codec("zstd").compress(planes, asbytes=True)


def unpack(packed: bytes, n: int, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.Codec("zstd").decompress(packed, size * n, asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(size, n).T).view(kind).ravel()


def pair_keys(h: np.ndarray, after: np.ndarray) -> np.ndarray:
    """One hash of two."""
    x = h.view(np.uint64) * _A ^ (after.view(np.uint64) + _B) * _B
    x ^= x >> np.uint64(31)
    return ((x * _A) ^ (x >> np.uint64(17))).view(np.int64)


def _shards(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each shard: its keys, folds and sizes, the numbers of its tokens and the hashes of its words, ascending."""
    kind = docs.schema[key].dataType.simpleString()
    held = F.coalesce(F.crc32(F.col(key).cast("string")) % FOLDS == HELD_OUT, F.lit(False))
    schema = f"shard bigint, ids array<{kind}>, held array<boolean>, sizes array<int>, codes binary, n_words int, words binary, tokens bigint, trained bigint"
    names = [c.split()[0] for c in schema.split(", ")]

    def shard(number, rows):
        table = pa.Table.from_batches(rows).combine_chunks()
        numbers, sizes, words = encode(table.column(2).combine_chunks().cast(pa.large_string()))
        held = table.column(1).combine_chunks().to_numpy(zero_copy_only=False)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words.cast(pa.large_binary()).to_pylist(), repeat(42)), dtype=np.uint64, count=len(words))
        order = np.argsort(hashes)
        rank = np.zeros(len(order) + 1, dtype=np.int32)
        rank[order + 1] = np.arange(1, len(order) + 1)
        row = (number, table.column(0).to_pylist(), held.tolist(), sizes.tolist(), pack(rank[numbers]), len(order), pack(hashes[order]), len(numbers), int(sizes[~held].sum()))
        types = (pa.int64(), pa.list_(table.schema.field(0).type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    def run(batches):
        number, waiting, size = TaskContext.get().partitionId() << 24, [], 0
        for whole in batches:
            step = max(1, whole.num_rows * SHARD_BYTES // (4 * max(1, whole.column(2).nbytes)))
            for i in range(0, whole.num_rows, step):
                waiting.append(whole.slice(i, step))
                size += waiting[-1].column(2).nbytes
                if size >= SHARD_BYTES:
                    yield shard(number, waiting)
                    number, waiting, size = number + 1, [], 0
        if waiting:
            yield shard(number, waiting)

    return docs.select(key, held.alias("held"), text).mapInArrow(run, schema)


class Shard:
    """The distinct n-grams of a shard. Words by number (0 the end of a text), ``start`` the number of a text's start."""

    def __init__(self, row: dict, triples: bool = True):
        self.sizes = np.asarray(row["sizes"], dtype=np.int64)
        self.held = np.asarray(row["held"], dtype=bool)
        self.numbers = unpack(row["codes"], row["tokens"], "<i4").astype(np.int64)
        self.start = row["n_words"] + 1
        end = np.array([xxhash.xxh64_intdigest(b"", 42)], dtype=np.uint64)
        word = np.concatenate([end.view(np.int64), unpack(row["words"], row["n_words"], "<i8"), [_START]])
        self.first = np.cumsum(self.sizes) - self.sizes
        train = np.repeat(~self.held, self.sizes).astype(np.float64)
        before = np.concatenate([[self.start], self.numbers[:-1]])
        before[self.first] = self.start
        pair, self.pair_at = np.unique(before * self.start + self.numbers, return_inverse=True)
        self.history, self.label = pair // self.start, pair % self.start
        names = [word[:-1], pair_keys(word[self.history], word[self.label])]
        own = [np.bincount(self.numbers, train, self.start), np.bincount(self.pair_at, train, len(pair))]
        if triples:
            self.triple_at = np.full(len(self.numbers), -1)
            later = np.ones(len(self.numbers), dtype=bool)
            later[self.first] = False
            at = np.flatnonzero(later)
            triple, self.triple_at[at] = np.unique(self.pair_at[at - 1] * self.start + self.numbers[at], return_inverse=True)
            self.prefix = triple // self.start
            self.suffix = np.zeros(len(triple), dtype=np.int64)
            self.suffix[self.triple_at[at]] = self.pair_at[at]
            names.append(pair_keys(names[1][self.prefix], word[triple % self.start]))
            own.append(np.bincount(self.triple_at[at], train[at], len(triple)))
        self.names, self.own = [n.view(np.uint64) for n in names], [n.astype(np.int64) for n in own]

    def parcels(self, kind: int, ranges: int, use: np.ndarray | None = None):
        """(range, size, hashes, counts) of the n-grams of a kind (those in ``use``)."""
        name, own = self.names[kind], self.own[kind]
        if use is not None:
            name, own = name[use], own[use]
        order = np.argsort(name)
        name, own = name[order], own[order]
        cut = [0, *np.searchsorted(name, bounds(ranges)).tolist(), len(name)]
        for r, (a, b) in enumerate(zip(cut, cut[1:])):
            if b > a:
                yield r, b - a, pack(name[a:b]), pack(own[a:b])

    def answered(self, kind: int, parts: list[np.ndarray], use: np.ndarray | None = None) -> np.ndarray:
        """Twice the global counts of the n-grams of a kind, and one more if other shards hold it too, from the answers in
        the order of ranges; where not asked, an n-gram is in no other shard."""
        out = 2 * self.own[kind]
        at = np.arange(len(out)) if use is None else np.flatnonzero(use)
        if len(at):
            out[at[np.argsort(self.names[kind][at])]] = np.concatenate(parts)
        return out

    def asked(self, pairs: np.ndarray) -> np.ndarray:
        """Which triples may be in other shards, given the answers for pairs."""
        shared = pairs % 2 == 1
        return shared[self.prefix] & shared[self.suffix]


def bounds(ranges: int) -> np.ndarray:
    """Where the second and later ranges of hashes begin."""
    return np.array([i * ((1 << 64) // ranges) for i in range(1, ranges)], dtype=np.uint64)


_PARCEL = "kind int, span int, shard bigint, size int, hashes binary, counts binary"
_ANSWER = "kind int, span int, shard bigint, size int, counts binary, distinct bigint"


def _table(rows: list[tuple], schema: str) -> pa.Table:
    fields = [c.split() for c in schema.split(", ")]
    types = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
    return pa.table([pa.array([r[i] for r in rows], types[t]) for i, (_, t) in enumerate(fields)], names=[n for n, _ in fields])


def _added_up(group: pa.Table) -> pa.Table:
    """The parcels of one kind and range -> their answers; ``distinct`` (in the first) counts n-grams seen in training."""
    sizes = group.column("size").to_numpy().astype(np.int64)
    both = [[unpack(p.as_py(), n, k) for p, n in zip(group.column(c), sizes.tolist())] for c, k in (("hashes", "<u8"), ("counts", "<i8"))]
    name, own = map(np.concatenate, both)
    order = np.argsort(name, kind="stable")
    new = np.concatenate([[True], name[order][1:] != name[order][:-1]])
    head = np.flatnonzero(new)
    total = np.add.reduceat(own[order], head)
    out = np.empty(len(name), dtype=np.int64)
    out[order] = (2 * total + (np.diff(np.append(head, len(name))) > 1))[np.cumsum(new) - 1]
    parts = np.split(out, np.cumsum(sizes)[:-1])
    kind, span, shard = (group.column(c).to_pylist() for c in ("kind", "span", "shard"))
    return _table([(k, r, s, len(p), pack(p), int((total > 0).sum()) if i == 0 else 0) for i, (k, r, s, p) in enumerate(zip(kind, span, shard, parts))], _ANSWER)


def _answers(table: pa.Table, kind: int) -> list[np.ndarray]:
    rows = sorted((r for r in table.to_pylist() if r["kind"] == kind), key=lambda r: r["span"])
    return [unpack(r["counts"], r["size"], "<i8") for r in rows]


class Automaton:
    """States are histories of ORDER 0, 1 and 2: none, word numbers, pair numbers. An arc of order k is the
    n-gram of k words and its label; it exists if training has seen it."""

    def __init__(self, s: Shard, words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, tokens: int, distinct: int):
        k = CONCENTRATION
        root = (words + 0.5) / (tokens + 0.5 * (distinct + 1))
        of = np.append(words, words[0])  # a text starts as often as it ends
        two = (pairs + k * root[s.label]) / (of[s.history] + k)
        three = (triples + k * two[s.suffix]) / (pairs[s.prefix] + k)
        self.root, self.weights = np.log10(root), (np.log10(root), np.log10(two), np.log10(three))
        self.known = (words > 0, pairs > 0, triples > 0)
        self.failure = (np.log10(k / (of + k)), np.log10(k / (pairs + k)))

    def step(self, order, state, word, pair, triple):
        """(order, state) after a word, and the weight: arcs of the state's order, else its failure arc and so on."""
        total, done = np.zeros(len(order)), np.zeros(len(order), dtype=bool)
        for level, arc in ((2, triple), (1, pair)):
            here = np.flatnonzero(~done & (order == level))
            hit = self.known[level][arc[here]]
            total[here[hit]] += self.weights[level][arc[here[hit]]]
            done[here[hit]] = True
            lost = here[~hit]
            total[lost] += self.failure[level - 1][state[lost]]
            order, state = order.copy(), state.copy()
            order[lost] -= 1
            if level == 2:  # from a pair to its second word
                state[lost] = self.second[state[lost]]
        total[~done] += self.root[word[~done]]
        longest = np.where(self.known[1][pair], 2, np.where(self.known[0][word], 1, 0))
        return longest, np.where(longest == 2, pair, word), total

    def score(self, s: Shard) -> np.ndarray:
        """Log10 probability of each text. Lanes of LANE tokens are walked left to right side by side; a lane that
        doesn't begin a text first walks the two tokens before it unscored, which bring it to the state of the whole walk."""
        self.second = s.label
        lanes = -(-s.sizes // LANE)
        doc = np.repeat(np.arange(len(s.sizes)), lanes)
        turn = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = s.first[doc] + turn * LANE
        length = np.minimum(LANE, s.first[doc] + s.sizes[doc] - at)
        order, state = np.where(turn == 0, 1, 0), np.where(turn == 0, s.start, 0)
        by = np.argsort(-length, kind="stable")
        at, length, order, state, fresh, total = at[by], length[by], order[by], state[by], (turn > 0)[by], np.zeros(len(doc))
        for back in (2, 1):
            on = np.flatnonzero(fresh)
            i = at[on] - back
            order[on], state[on], _ = self.step(order[on], state[on], s.numbers[i], s.pair_at[i], s.triple_at[i])
            if back == 2:  # without what comes before it, a first word leads to itself
                word = s.numbers[i]
                order[on], state[on] = np.where(self.known[0][word], 1, 0), word
        live = len(doc)
        for t in range(int(length.max(initial=0))):
            live = int(np.searchsorted(-length[:live], -t, "left"))
            i = at[:live] + t
            order[:live], state[:live], weight = self.step(order[:live], state[:live], s.numbers[i], s.pair_at[i], s.triple_at[i])
            total[:live] += weight
        out = np.zeros(len(s.sizes))
        np.add.at(out, doc[by], total)
        return out


def scores(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score: a row for each document."""
    spark = docs.sparkSession
    name = f"texts_{uuid.uuid4().hex}"
    made = _shards(docs, key, text)
    spread = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made.write.bucketBy(spread, "shard").option("path", new_path(spark, "texts")).option("compression", "uncompressed").saveAsTable(name)
    texts = spark.table(name)
    size = texts.agg(F.sum("tokens"), F.sum("trained")).first()  # one row
    ranges, tokens = -(-(size[0] or 1) // RANGE_TOKENS), size[1] or 0

    def ask(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                s = Shard(row, triples=False)
                for kind in (WORD, PAIR):
                    rows = [(kind, r, row["shard"], n, h, c) for r, n, h, c in s.parcels(kind, ranges)]
                    yield from _table(rows, _PARCEL).to_batches()

    def ask_triples(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        s = Shard(row)
        use = s.asked(s.answered(PAIR, _answers(right, PAIR)))
        return _table([(TRIPLE, r, row["shard"], n, h, c) for r, n, h, c in s.parcels(TRIPLE, ranges, use)], _PARCEL)

    def answer(parcels: DataFrame) -> DataFrame:
        return written(parcels.groupBy("kind", "span").applyInArrow(_added_up, _ANSWER), "answers")

    counts = answer(texts.mapInArrow(ask, _PARCEL))
    distinct = int(counts.where(F.col("kind") == WORD).agg(F.sum("distinct")).first()[0] or 0)
    by_shard = texts.groupBy("shard")
    triples = answer(by_shard.cogroup(counts.groupBy("shard")).applyInArrow(ask_triples, _PARCEL))

    id_type = docs.schema[key].dataType.simpleString()
    names = [key, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        s = Shard(row)
        words, pairs = (s.answered(kind, _answers(right, kind)) for kind in (WORD, PAIR))
        of_triples = s.answered(TRIPLE, _answers(right, TRIPLE), s.asked(pairs))
        words, pairs, of_triples = words // 2, pairs // 2, of_triples // 2
        machine = Automaton(s, words, pairs, of_triples, tokens, distinct)
        doc = np.repeat(np.arange(len(s.sizes)), s.sizes)
        base = np.bincount(doc, machine.root[s.numbers], len(s.sizes))
        seen = np.bincount(doc, words[s.numbers] > 0, len(s.sizes)).astype(np.int64)
        columns = [pa.array(row["ids"], left.schema.field("ids").type.value_type), pa.array(s.held), pa.array(s.sizes), pa.array(seen), pa.array(np.full(len(s.sizes), tokens)), pa.array(base), pa.array(machine.score(s))]
        return pa.table(columns, names=names)

    both = counts.unionByName(triples)
    found = by_shard.cogroup(both.groupBy("shard")).applyInArrow(run, f"`{key}` {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    out = written(found, "scores")
    for table in (texts, counts, triples):
        discard(table)
    spark.sql(f"drop table {name}")
    return out
