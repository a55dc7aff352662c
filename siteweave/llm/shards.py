"""Training-order materialisation: token sequences in fixed-stride binary shards.

Each task joins its documents' ids (an end id after each) to sequences of ``length`` ids;
only its last one is filled up. The sequences are numbered across tasks, and a keyed Feistel
permutation with cycle-walking gives each number a slot in [0, N): the training order, which
needs no sort by random keys and can be inverted. Shard s holds the slots from s * per_shard
on, each at a multiple of the stride, so a reader resumes at any slot by one seek.

A shard is written by one task, under a name of the attempt, and then renamed; an attempt that
finds the shard there drops its own copy of the same bytes.

Defined edge cases: a null or empty text is its end id alone; repeated rows are written each
time; columns besides key and text are not read; an empty table writes no shard.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siteweave.llm import tokens
from siteweave.plans.store import children, new_path, written

LENGTH = 2048
END = 0
ROUNDS = 6
#: Bytes of a shard, at most.
SHARD_BYTES = 64 << 20
#: Tasks that write shards, at most, for each shuffle partition of the session.
TASKS = 16


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """The slots of the numbers 0 .. n-1: a Feistel network over the next power of four, walked until inside."""
    half = max(1, (int(max(n - 1, 1)).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.array([zlib.crc32(f"{key}:{r}".encode()) for r in range(ROUNDS)], dtype=np.uint64)

    def once(v):
        left, right = v >> np.uint64(half), v & mask
        for k in keys:
            mixed = (right ^ k) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (mixed >> np.uint64(33)) & mask
        return left << np.uint64(half) | right

    out = once(x.astype(np.uint64))
    while (outside := out >= np.uint64(n)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def width(tokenizer: str | None = None) -> np.dtype:
    """Unsigned numbers that hold every id of the vocabulary: two bytes each up to 65536 ids, else four."""
    return np.dtype("<u2" if tokens.encoder(tokenizer or tokens.default_path()).tokenizer.get_vocab_size() <= 1 << 16 else "<u4")


def sequences(docs: DataFrame, length: int, tokenizer: str | None, key: str, text: str) -> DataFrame:
    """part, nth, ids, pieces: which documents' ids a sequence holds."""
    path = tokenizer or tokens.default_path()
    kind = docs.schema[key].dataType.simpleString()
    schema = f"part bigint, nth bigint, ids binary, pieces array<struct<id: {kind}, start: bigint, length: bigint, offset: bigint>>"
    word = width(path)

    def rows(part, nth, ids, keys, piece):
        """Whole sequences from the nth on; piece: (sequence, start, length, offset) of each piece, in order."""
        n = len(ids) // length
        bodies = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length * word.itemsize), n, [None, pa.py_buffer(ids)]).cast(pa.binary())
        inner = pa.StructArray.from_arrays([keys, *map(pa.array, piece[1:])], ["id", "start", "length", "offset"])
        lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(piece[0], np.arange(nth, nth + n + 1)), pa.int32()), inner)
        for i in range(0, n, 512):
            m = min(512, n - i)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(m, part)), pa.array(np.arange(nth + i, nth + i + m)), bodies.slice(i, m), lists.slice(i, m)], ["part", "nth", "ids", "pieces"])

    def run(batches):
        part, nth, at = TaskContext.get().partitionId(), 0, 0  # at: ids so far
        held, held_keys, held_pieces = np.zeros(0, dtype=word), None, np.zeros((4, 0), dtype=np.int64)
        for b in batches:
            ids, n = tokens.with_end(*tokens.encoder(path).encode(b.column(1)), END)
            # a document is cut where a sequence ends
            end = at + np.cumsum(n)
            begin = end - n
            times = (end - 1) // length - begin // length + 1
            doc = np.repeat(np.arange(len(n)), times)
            which = np.repeat(begin // length, times) + np.arange(len(doc)) - np.repeat(np.cumsum(times) - times, times)
            low, high = np.maximum(begin[doc], which * length), np.minimum(end[doc], (which + 1) * length)
            pieces = np.concatenate([held_pieces, np.stack([which, low - begin[doc], high - low, low - which * length])], axis=1)
            keys = b.column(0).take(pa.array(doc))
            keys = keys if held_keys is None else pa.concat_arrays([held_keys, keys])
            ids = np.concatenate([held, ids.astype(word)])
            at += int(n.sum())
            full = len(ids) // length
            cut = int(np.searchsorted(pieces[0], nth + full))
            if full:
                yield from rows(part, nth, ids[: full * length], keys.slice(0, cut), pieces[:, :cut])
            held, held_keys, held_pieces, nth = ids[full * length :], keys.slice(cut), pieces[:, cut:], nth + full
        if len(held):
            yield from rows(part, nth, np.concatenate([held, np.full(length - len(held), END, dtype=word)]), held_keys, held_pieces)

    return docs.select(key, text).mapInArrow(run, schema)


def materialise(docs: DataFrame, out: str | None = None, seed: int = 1, length: int = LENGTH, tokenizer: str | None = None, shard_bytes: int = SHARD_BYTES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes shard-NNNNNN.bin files to ``out``, a new or empty folder that all executors see, once; the result is a written table.

    A row for each piece of a document: key, start, length, ids_crc32, shard, slot, offset.
    """
    spark = docs.sparkSession
    folder = out or new_path(spark, "shards")
    if children(spark, folder):
        raise ValueError(f"{folder} isn't empty: shards of another run may be there")
    made = written(sequences(docs, length, tokenizer, key, text), "sequences")
    sizes = made.groupBy("part").agg(F.count("*").alias("n"))  # a row for each task
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("base"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    word = width(tokenizer)
    stride = length * word.itemsize
    per_shard = max(1, shard_bytes // stride)
    shards = max(1, -(-total // per_shard))
    kind = docs.schema[key].dataType.simpleString()
    piece = f"array<struct<id: {kind}, start: bigint, length: bigint, offset: bigint>>"

    def place(batches):
        codec = pa.Codec("zstd", compression_level=9)  # only for the way to the shards; the table is compressed as a whole
        for b in batches:
            slot = permuted(b.column(0).to_numpy(), total, seed)
            packed = pa.array([codec.compress(x.as_buffer(), asbytes=True) for x in b.column(1)], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(slot // per_shard), pa.array(slot), packed, b.column(2)], ["shard", "slot", "ids", "pieces"])

    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        codec, shard, sink, name = pa.Codec("zstd"), None, None, ""

        def finish():
            if sink is not None:
                sink.close()
                whole = f"{root}/shard-{shard:06d}.bin"
                if store.get_file_info(whole).type == fs.FileType.NotFound:
                    store.move(name, whole)
                else:  # an earlier attempt of this task has written the same bytes
                    store.delete_file(name)

        for b in batches:
            if not b.num_rows:
                continue
            own_shard, slot, pieces, crc = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3), []
            inner = pieces.flatten()
            size, offset = inner.field("length").to_numpy(), inner.field("offset").to_numpy()
            many = pieces.value_lengths().to_numpy()
            ends = np.cumsum(many).tolist()
            for s, packed, first, last in zip(own_shard.tolist(), b.column(2), [0, *ends], ends):
                if s != shard:
                    finish()
                    shard, name = s, f"{root}/.{uuid.uuid4().hex}"
                    store.create_dir(root, recursive=True)
                    sink = store.open_output_stream(name)
                ids = codec.decompress(packed.as_buffer(), stride, asbytes=True)
                sink.write(ids)
                wide = memoryview(np.frombuffer(ids, dtype=word).astype("<u4")).cast("B")
                crc += [zlib.crc32(wide[4 * o : 4 * (o + n)]) for o, n in zip(offset[first:last].tolist(), size[first:last].tolist())]
            numbers = (inner.field("start"), inner.field("length"), pa.array(crc, pa.int64()), pa.array(np.repeat(own_shard, many)), pa.array(np.repeat(slot, many)), inner.field("offset"))
            yield pa.RecordBatch.from_arrays([inner.field("id"), *numbers], names)
        finish()

    names = [key, "start", "length", "ids_crc32", "shard", "slot", "offset"]
    numbered = made.join(F.broadcast(base), "part").select((F.col("base") + F.col("nth")).alias("i"), "ids", "pieces")  # a row for each task
    placed = numbered.mapInArrow(place, f"shard bigint, slot bigint, ids binary, pieces {piece}")
    # a range of slots, which is a shard or some in a row, for each task
    in_a_row = -(-shards // (TASKS * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = placed.repartitionById(-(-shards // in_a_row), F.floor(F.col("shard") / in_a_row).cast("int")).sortWithinPartitions("slot")
    return written(dealt.mapInArrow(write, f"`{key}` {kind}, " + ", ".join(f"{c} bigint" for c in names[1:])), "placed")


def read_sequences(path: str, start: int, count: int, length: int = LENGTH, shard_bytes: int = SHARD_BYTES, tokenizer: str | None = None) -> np.ndarray:
    """The sequences of slots start .. start + count - 1, by seeks; fewer at the end."""
    word = width(tokenizer)
    stride = length * word.itemsize
    per_shard, out = max(1, shard_bytes // stride), []
    store, root = fs.FileSystem.from_uri(path)
    while count > 0:
        shard, at = divmod(start, per_shard)
        name = f"{root}/shard-{shard:06d}.bin"
        if store.get_file_info(name).type == fs.FileType.NotFound:
            break
        with store.open_input_file(name) as f:
            f.seek(at * stride)
            got = f.read(min(count, per_shard - at) * stride)
        if not got:
            break
        out.append(np.frombuffer(got, dtype=word).reshape(-1, length))
        start, count = start + len(out[-1]), count - len(out[-1])
    return np.concatenate(out) if out else np.zeros((0, length), dtype=word)
