"""Conversation prefix trie: which openings conversations share, and what sharing them saves.

A turn becomes a token of 20 bytes, the digest of its role and text and the text's size, so a conversation is a byte
string whose order is that of its turns' tokens. Equal conversations become one row first, with the number, the least
key and the digest of the keys of all of them; the keys of one sequence are put together in pieces by several tasks.

Distinct sequences are dealt by ranges. A shard is a run of a range that fits in memory (``SHARD_TURNS``): its tokens
are encoded by a dictionary in their order, and its sequences are inserted into a ternary search tree, the middle one
first, then those of both halves, which keeps the trees of siblings balanced. One pass over the nodes, children before
parents, adds up members, leaves and bytes.

Neighbouring shards share the nodes of the prefix that the last sequence of the one and the first of the other have in
common. Nodes on the first and last path of a shard are therefore sent out as parts and added up; a shared node's bytes
and its place among its parent's children are counted once for each shard, so for each boundary the surplus is taken
off along the common prefix. All other nodes are complete within their shard.

Defined edge cases: rows with a null key belong to no conversation; a null turn comes first, null roles and texts are
empty; turns of equal number stand by role, then by the digest of the turn, and repeated rows are turns of their own; an
empty table has no nodes, and where every conversation is without turns the root is the only node, its own leaf; other
columns aren't read. One conversation's tokens are one row: 20 bytes a turn, some 100 while they are sorted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteweave.plans.store import discard, written

TOKEN = 20
#: Turns of a shard (a longer sequence is a shard of its own), keys of a piece, nodes of a batch.
SHARD_TURNS, PIECE, BATCH = 1 << 18, 1 << 15, 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()
_LARGEST = np.iinfo(np.int64).max

_PIECES = "seq binary, low bigint, n bigint, ids binary"
_NODES = (
    "path binary, parent_path binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, gross bigint, net bigint, ends_sha256 string, part int, first binary, last binary"
)
_FIELDS = [(c.split()[0], {"binary": pa.binary(), "bigint": pa.int64(), "string": pa.string(), "int": pa.int32()}[c.split()[1]]) for c in _NODES.split(", ")]


def sequences(turns: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, seq: the tokens of each conversation in order."""
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    token = F.concat(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said)), F.lpad(F.hex(F.octet_length(said)), 8, "0"))
    placed = F.struct(F.col(turn).isNotNull().alias("has"), F.col(turn).alias("at"), who.alias("who"), token.alias("token"))
    rows = turns.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("conv_id"), placed.alias("t"))
    in_order = F.array_join(F.transform(F.array_sort(F.collect_list("t")), lambda t: t["token"]), "")
    return rows.groupBy("conv_id").agg(F.unhex(in_order).alias("seq"))


def rebuilt(seqs: DataFrame, group: int = 5, spread: int = 9) -> DataFrame:
    """Conversations c that open with the first h turns of conversation c - c % group, h = crc32(c) % spread,
    and go on with their own turns after the first h."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % spread
    base = F.col("conv_id") - F.col("conv_id") % group
    heads = seqs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.substring("seq", 1, TOKEN * (spread - 1)).alias("head"))
    met = seqs.withColumn("base", base).withColumn("h", (h * TOKEN).cast("int")).join(heads, "base", "left")
    opening = F.substring(F.coalesce("head", F.lit(b"")), F.lit(1), F.col("h"))
    return met.select("conv_id", F.concat(opening, F.substring("seq", F.col("h") + 1, F.octet_length("seq"))).alias("seq"))


def _pieces(batches):
    """Rows sorted by (seq, conv_id) -> distinct sequences with up to PIECE of their keys."""
    at, ids = None, []

    def done():
        return pa.RecordBatch.from_arrays([pa.array([at], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([",".join(map(str, ids)).encode()], pa.binary())], ["seq", "low", "n", "ids"])

    waiting = []
    for b in batches:
        for seq, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if ids and (seq != at or len(ids) == PIECE):
                waiting.append(done())
                ids = []
            at = seq
            ids.append(conv)
        if len(waiting) > 4096:
            yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()
            waiting = []
    if ids:
        waiting.append(done())
    if waiting:
        yield from pa.Table.from_batches(waiting).combine_chunks().to_batches()


class Tree:
    """A ternary search tree over dictionary numbers. A node's eq leads to the tree of its children."""

    def __init__(self):
        self.token, self.low, self.eq, self.high, self.up, self.depth = [-1], [0], [0], [0], [0], [0]
        self.count, self.least, self.ends = [0], [_LARGEST], [None]

    def _add(self, token: int, up: int) -> int:
        for column, value in ((self.token, token), (self.low, 0), (self.eq, 0), (self.high, 0), (self.up, up), (self.depth, self.depth[up] + 1), (self.count, 0), (self.least, _LARGEST), (self.ends, None)):
            column.append(value)
        return len(self.token) - 1

    def insert(self, tokens: list[int], count: int, least: int, ends: str) -> int:
        node = 0
        for token in tokens:
            at, links, parent = self.eq[node], self.eq, node
            while at and self.token[at] != token:
                links, parent = (self.low, at) if token < self.token[at] else (self.high, at)
                at = links[parent]
            if not at:
                at = links[parent] = self._add(token, node)
            node = at
        self.count[node], self.least[node], self.ends[node] = count, least, ends
        return node

    def add_up(self, sizes: list[int]) -> None:
        """A child stands after its parent, so one pass from the end sees children first."""
        n = len(self.token)
        self.children, self.leaves, self.gross, self.net = [0] * n, [0] * n, [0] * n, [0] * n
        for i in range(n - 1, 0, -1):
            size, p = sizes[self.token[i]], self.up[i]
            self.leaves[i] = self.leaves[i] or 1
            self.gross[i] += self.count[i] * size
            self.net[i] += size
            self.count[p] += self.count[i]
            self.least[p] = min(self.least[p], self.least[i])
            self.children[p] += 1
            for column in (self.leaves, self.gross, self.net):
                column[p] += column[i]
        self.leaves[0] = self.leaves[0] or 1


def _by_halves(n: int):
    todo = [(0, n)]
    while todo:
        a, b = todo.pop()
        if a < b:
            mid = (a + b) // 2
            yield mid
            todo += [(mid + 1, b), (a, mid)]


def _paths(seq: bytes) -> list[bytes]:
    """The name of each prefix, by its number of turns."""
    digest, out = hashlib.md5(usedforsecurity=False), []
    for i in range(0, len(seq) + 1, TOKEN):
        out.append(digest.digest())
        digest.update(seq[i : i + TOKEN])
    return out


def _surplus(left: bytes, right: bytes) -> list[dict]:
    """What both shards count of the nodes they share, from the last sequence of one and the first of the next."""
    common = 0
    while common < min(len(left), len(right)) and left[common : common + TOKEN] == right[common : common + TOKEN]:
        common += TOKEN
    common //= TOKEN
    paths, net, leaf, out = _paths(left[: common * TOKEN]), 0, -int(len(left) == common * TOKEN), []
    for d in range(common, -1, -1):
        net += int.from_bytes(left[d * TOKEN - 4 : d * TOKEN], "big") if d else 0
        out.append({"path": paths[d], "depth": d, "n_convs": 0, "n_children": -int(d < common), "n_leaves": leaf, "gross": 0, "net": -net})
    return out


def _batches(rows: list[dict]):
    for i in range(0, len(rows), BATCH):
        some = rows[i : i + BATCH]
        yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in some], t) for n, t in _FIELDS], [n for n, _ in _FIELDS])


def _shard(found: list[tuple[bytes, int, int, str]]) -> list[dict]:
    """The nodes of some distinct sequences (seq, count, least, ends), sorted by seq."""
    joined = np.frombuffer(b"".join(f[0] for f in found), np.dtype((np.void, TOKEN)))
    known, numbers = np.unique(joined, return_inverse=True)
    numbers = numbers.tolist()
    sizes = [int.from_bytes(t.tobytes()[-4:], "big") for t in known]
    at = np.concatenate([[0], np.cumsum([len(f[0]) // TOKEN for f in found])]).tolist()
    tree, end = Tree(), {}
    for i in _by_halves(len(found)):
        end[i] = tree.insert(numbers[at[i] : at[i + 1]], *found[i][1:])
    tree.add_up(sizes)
    path = {}
    for i in {0, len(found) - 1}:
        node, names = end[i], _paths(found[i][0])
        for name in reversed(names):
            path[node] = name
            node = tree.up[node]
    out = []
    for i in range(len(tree.token)):
        up = tree.up[i] if i else None
        edge = None if up is None else path.get(up)
        out.append(
            {
                "path": path.get(i), "parent_path": edge, "depth": tree.depth[i], "conv_id": tree.least[i],
                "parent_conv_id": None if up is None or edge is not None else tree.least[up], "n_convs": tree.count[i], "n_children": tree.children[i],
                "n_leaves": tree.leaves[i], "gross": tree.gross[i], "net": tree.net[i], "ends_sha256": tree.ends[i],
            }
        )
    return out


def _shards(most: int):
    """Pieces sorted by (seq, low) -> nodes, surplus at the boundaries inside this range, and its first and last sequence."""

    def run(batches):
        part, found, turns, edge, last = TaskContext.get().partitionId(), [], 0, None, None
        seq, n, low, digest = None, 0, None, None

        def close():
            nonlocal found, turns, edge, last
            rows = _shard(found) + (_surplus(last, found[0][0]) if last is not None else [])
            edge, last = found[0][0] if edge is None else edge, found[-1][0]
            found, turns = [], 0
            return _batches(rows)

        for b in batches:
            for s, a, c, ids in zip(*(b.column(i).to_pylist() for i in range(4))):
                if s == seq:
                    digest.update(b",")
                else:
                    if seq is not None:
                        found.append((seq, n, low, digest.hexdigest()))
                        turns += len(seq) // TOKEN + 1
                        if turns >= most:
                            yield from close()
                    seq, n, low, digest = s, 0, a, hashlib.sha256()
                n += c
                digest.update(ids)
        if seq is not None:
            found.append((seq, n, low, digest.hexdigest()))
            yield from close()
            yield from _batches([{"part": part, "first": edge, "last": last}])

    return run


def nodes(seqs: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """seqs (conv_id, seq) -> conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row for each node."""
    seqs = seqs.select("seq", "conv_id")
    pieces = written(seqs.repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id").mapInArrow(_pieces, _PIECES), "pieces")
    found = written(pieces.repartitionByRange("seq").sortWithinPartitions("seq", "low").mapInArrow(_shards(shard_turns), _NODES), "nodes")
    discard(pieces)
    # boundaries between ranges: a row for each task
    parts = found.where("part is not null").select("part", "first", "last")
    follows = parts.select("part", F.lead("part").over(Window.orderBy("part")).alias("next")).where("next is not null")
    two = parts.select("part", "last").join(follows, "part").join(parts.select(F.col("part").alias("next"), "first"), "next").select("last", "first")

    def surplus(batches):
        for b in batches:
            for left, right in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                yield from _batches(_surplus(left, right))

    edges = found.where("part is null and path is not null").unionByName(two.mapInArrow(surplus, _NODES))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "gross", "net")]
    edges = written(edges.groupBy("path").agg(F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.min("parent_path").alias("parent_path"), *sums, F.max("ends_sha256").alias("ends_sha256")), "edges")
    inner = found.where("part is null and path is null")
    above = edges.select(F.col("path").alias("parent_path"), F.col("conv_id").alias("above"))
    columns = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "gross", "net", "ends_sha256"]
    hung = inner.where("parent_path is not null").select("parent_path", *columns).unionByName(edges.where("parent_path is not null").select("parent_path", *columns)).join(above, "parent_path")
    root = edges.where("parent_path is null").select(*columns, F.lit(None).cast("long").alias("parent_conv_id"))
    whole = inner.where("parent_path is null").select(*columns, "parent_conv_id").unionByName(hung.select(*columns, F.col("above").alias("parent_conv_id"))).unionByName(root)
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("gross") - F.col("net")).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def rebuilt_nodes(turns: DataFrame, shard_turns: int = SHARD_TURNS, **names: str) -> DataFrame:
    """The trie of the rebuilt conversations of a table of turns."""
    own = written(sequences(turns, **names), "turns")
    whole = written(rebuilt(own), "rebuilt")
    discard(own)
    return nodes(whole, shard_turns)
