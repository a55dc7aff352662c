"""Language identification by a bidirectional gated recurrent network over bytes.

A text's bytes are read in windows of ``WIDTH``, all of them. In each window one network reads forwards and one
backwards; both states at a byte give that byte's probabilities of the languages. A document's probabilities are the
mean over its letter bytes (ASCII letters and bytes of other scripts), its language the most probable one.

Training runs in numpy by backpropagation through time over the windows, with the loss at every letter byte, on a
bounded sample: of each language the ``DOCS`` documents with the least hash of their key, of each at most ``PIECES``
windows evenly over the whole text, so at most DOCS * PIECES * WIDTH bytes for each language reach the driver.
The sample is chosen from keys and languages alone; texts are read for chosen keys only. Prediction works on windows of
many documents at once, in tasks, with memory bounded by ``LANES`` windows.

Defined edge cases: a null text or one without a letter is ``und`` with score 0; a null language is not learned from; a
document with a null key is not learned from and not held out; repeated rows are judged one by one; where nothing can be
learned every text is ``und`` with score 0; languages of equal probability: the first by name; other columns aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH, HIDDEN, LANES = 64, 8, 4096
#: The sample's bound: documents for each language, windows for each document.
DOCS, PIECES = 240, 6
#: Training: windows a step, passes over the sample, steps at least, rate.
STEP, PASSES, STEPS, RATE = 256, 6, 120, 0.03
UNKNOWN = "und"
LETTER = np.array([chr(i).isascii() and chr(i).isalpha() or i >= 128 for i in range(256)])


def cut(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of texts of the given sizes: text, start in it, length."""
    n = -(-sizes // WIDTH)
    of = np.repeat(np.arange(len(sizes)), n)
    start = (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)) * WIDTH
    return of, start, np.minimum(WIDTH, sizes[of] - start)


def steps(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """(WIDTH, windows) bytes; past a window's end zeros."""
    at = np.arange(WIDTH)[:, None]
    return np.where(at < length, data[np.minimum(start + at, max(len(data) - 1, 0))], 0) if len(data) else np.zeros((WIDTH, len(start)), np.uint8)


class Direction:
    """A gated recurrent unit: rows of gates are reset, update, candidate; states are columns."""

    def __init__(self, r: np.random.Generator):
        self.given = (r.standard_normal((3 * HIDDEN, 256)) * 0.3).astype(np.float32)
        self.again = (r.standard_normal((3 * HIDDEN, HIDDEN)) / HIDDEN**0.5).astype(np.float32)
        self.bias = np.zeros((HIDDEN, 1), np.float32)

    def states(self, text: np.ndarray, keep: list | None = None) -> np.ndarray:
        """text (steps, lanes) -> states (steps, HIDDEN, lanes); keep gets what backpropagation needs."""
        lanes = text.shape[1]
        out = np.empty((len(text), HIDDEN, lanes), np.float32)
        h, g, a = np.zeros((HIDDEN, lanes), np.float32), np.empty((3 * HIDDEN, lanes), np.float32), np.empty((3 * HIDDEN, lanes), np.float32)
        gates, candidate = slice(0, 2 * HIDDEN), slice(2 * HIDDEN, None)
        for t, bytes_ in enumerate(text):
            np.take(self.given, bytes_, axis=1, out=g, mode="clip")
            np.dot(self.again, h, out=a)
            both, inner = g[gates], a[candidate]
            both += a[gates]
            both *= 0.5
            np.tanh(both, out=both)
            both += 1
            both *= 0.5
            reset, update = both[:HIDDEN], both[HIDDEN:]
            inner += self.bias
            new = g[candidate]
            np.multiply(reset, inner, out=a[:HIDDEN])
            new += a[:HIDDEN]
            np.tanh(new, out=new)
            if keep is not None:
                keep.append((h.copy(), reset.copy(), update.copy(), new.copy(), inner.copy()))
            h = out[t]
            np.multiply(update, (keep[-1][0] if keep is not None else out[t - 1] if t else 0) - new, out=h)
            h += new
        return out

    def back(self, text: np.ndarray, kept: list, slope: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time from the slopes at the states."""
        d_again, d_bias = np.zeros_like(self.again), np.zeros_like(self.bias)
        d_given = np.empty((3 * HIDDEN, *text.shape), np.float32)
        dh = np.zeros(slope.shape[1:], np.float32)
        for t in range(len(text) - 1, -1, -1):
            h, reset, update, new, inner = kept[t]
            dh = dh + slope[t]
            d_new = dh * (1 - update) * (1 - new * new)
            d_reset = d_new * inner * reset * (1 - reset)
            d_update = dh * (h - new) * update * (1 - update)
            d_inner = d_new * reset
            gates = np.concatenate([d_reset, d_update, d_inner])
            d_again += gates @ h.T
            d_bias += d_inner.sum(1, keepdims=True)
            d_given[:, t] = np.concatenate([d_reset, d_update, d_new])
            dh = dh * update + self.again.T @ gates
        flat = text.ravel()
        return {"given": np.stack([np.bincount(flat, row.ravel(), 256) for row in d_given]), "again": d_again, "bias": d_bias}


class Network:
    def __init__(self, languages: list[str], seed: int = 7):
        r = np.random.default_rng(seed)
        self.languages, self.forth, self.back = languages, Direction(r), Direction(r)
        self.out = (r.standard_normal((len(languages), 2 * HIDDEN)) * 0.3).astype(np.float32)
        self.prior = np.zeros((len(languages), 1), np.float32)

    def probabilities(self, text: np.ndarray, kept: tuple | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(steps, languages, lanes) for bytes (steps, lanes), and the states of both directions."""
        a = self.forth.states(text, kept[0] if kept else None)
        b = self.back.states(text[::-1], kept[1] if kept else None)[::-1]
        p = np.matmul(self.out[:, :HIDDEN], a)
        p += np.matmul(self.out[:, HIDDEN:], b)
        p += self.prior
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p, a, b

    def slopes(self, text: np.ndarray, language: np.ndarray) -> list[tuple[object, str, np.ndarray]]:
        """Slopes of the mean loss at letter bytes; language: of each lane."""
        kept: tuple = ([], [])
        p, a, b = self.probabilities(text, kept)
        letters = LETTER[text]
        p[:, language, np.arange(text.shape[1])] -= 1
        p *= letters[:, None] / max(1, letters.sum())
        found = []
        for direction, bytes_, states, keep, half in ((self.forth, text, a, kept[0], slice(0, HIDDEN)), (self.back, text[::-1], b, kept[1], slice(HIDDEN, None))):
            slope = np.matmul(self.out[:, half].T, p)
            for name, d in direction.back(bytes_, keep, slope if half.start == 0 else slope[::-1]).items():
                found.append((direction, name, d))
        d_out = np.concatenate([np.einsum("tcn,thn->ch", p, s, optimize=True) for s in (a, b)], axis=1)
        return [*found, (self, "out", d_out), (self, "prior", p.sum((0, 2))[:, None])]

    def learn(self, text: np.ndarray, language: np.ndarray, passes: int = PASSES, seed: int = 7) -> None:
        """Adam over shuffled windows; text (WIDTH, windows)."""
        r, moments, n = np.random.default_rng(seed), {}, 0
        each = -(-len(language) // STEP)
        passes = max(passes, -(-STEPS // each))
        total = passes * each
        for _ in range(passes):
            order = r.permutation(len(language))
            for i in range(0, len(order), STEP):
                some = order[i : i + STEP]
                n += 1
                for owner, name, d in self.slopes(text[:, some], language[some]):
                    m, v = moments.get((id(owner), name), (0, 0))
                    m, v = 0.9 * m + 0.1 * d, 0.99 * v + 0.01 * d * d
                    moments[id(owner), name] = m, v
                    step = RATE * (1 - (n - 1) / total) * (m / (1 - 0.9**n)) / (np.sqrt(v / (1 - 0.99**n)) + 1e-8)
                    setattr(owner, name, (getattr(owner, name) - step).astype(np.float32))

    def documents(self, data: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """(documents, languages): mean probabilities over the letters of each text, 0 without one."""
        of, start, length = cut(sizes)
        total, letters = np.zeros((len(sizes), len(self.languages))), np.zeros(len(sizes))
        for i in range(0, len(of), LANES):
            some = slice(i, i + LANES)
            text = steps(data, first[of[some]] + start[some], length[some])
            p, _, _ = self.probabilities(text)
            is_letter = LETTER[text]
            np.multiply(p, is_letter[:, None], out=p)
            one = p.sum(0, dtype=np.float64)
            for c in range(len(self.languages)):
                total[:, c] += np.bincount(of[some], one[c], len(sizes))
            letters += np.bincount(of[some], is_letter.sum(0), len(sizes))
        return total / np.maximum(letters, 1)[:, None]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, first byte and size of each text; null has none."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets[:-1], np.diff(offsets)


def sample(docs: DataFrame, learned: Column, key: str, text: str, lang: str, docs_each: int = DOCS, pieces: int = PIECES) -> DataFrame:
    """lang, window: the bounded sample. Chosen by the hash of the key, without reading texts."""
    usable = docs.where(F.col(lang).isNotNull() & learned).select(F.col(lang).cast("string").alias("lang"), F.xxhash64(key).alias("u"), F.col(text).alias("text"))
    # hashes are spread evenly, so all but a few times as many as are wanted can be left out before rows are exchanged
    size = usable.groupBy("lang").agg(F.approx_count_distinct("u").alias("size"))
    near = usable.select("lang", "u").join(F.broadcast(size), "lang").where(F.col("u") <= -(2.0**63) + 2.0**64 * F.least(F.lit(1.0), 4.0 * docs_each / F.col("size")))
    order = Window.partitionBy("lang").orderBy("u")
    least = near.select("lang", "u").distinct().withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs_each).groupBy("lang").agg(F.max("u").alias("most"))
    chosen = usable.join(F.broadcast(least), "lang").where("u <= most")  # a row for each language
    once = chosen.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("u", F.xxhash64("text")))).where(F.col("n") <= docs_each)

    def windows(batches):
        for b in batches:
            data, first, sizes = _buffers(b.column(1))
            of, start, length = cut(sizes)
            n = np.bincount(of, minlength=len(sizes))
            place = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            keep = place * pieces // np.maximum(n[of], 1) != (place - 1) * pieces // np.maximum(n[of], 1)
            lang_of = b.column(0).take(pa.array(of[keep]))
            rows = [data[f + s : f + s + w].tobytes() for f, s, w in zip(first[of[keep]], start[keep], length[keep])]
            yield pa.RecordBatch.from_arrays([lang_of, pa.array(rows, pa.binary())], ["lang", "window"])

    return once.select("lang", "text").mapInArrow(windows, "lang string, window binary")


def trained(found: list[tuple[str, bytes]]) -> Network | None:
    """The network of the sample; None if there is none."""
    found = sorted(found)
    if not found:
        return None
    languages = sorted({f[0] for f in found})
    sizes = np.array([len(f[1]) for f in found])
    text = steps(np.frombuffer(b"".join(f[1] for f in found), np.uint8), np.cumsum(sizes) - sizes, sizes).astype(np.uint8)
    net = Network(languages)
    net.learn(text, np.searchsorted(languages, [f[0] for f in found]))
    return net


def identified(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """key, held_out, lang_pred, score: a row for each document. Learns from documents that aren't held out."""
    held = F.coalesce(held_out, F.lit(False))
    learned = F.col(key).isNotNull() & ~held
    net = trained([(r.lang, bytes(r.window)) for r in sample(docs, learned, key, text, lang).collect()])  # DOCS * PIECES windows for each language
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            has = np.array(b.column(2).to_pylist(), bool)
            if net is None or not b.num_rows:
                names, score = [UNKNOWN] * b.num_rows, np.zeros(b.num_rows)
            else:
                p = net.documents(*_buffers(b.column(3)))
                best = p.argmax(1)
                names = [net.languages[c] if h else UNKNOWN for c, h in zip(best, has)]
                score = np.where(has, np.round(p[np.arange(len(p)), best], 6), 0.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(score)], [key, "held_out", "lang_pred", "score"])

    has = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    return docs.select(key, held.alias("held_out"), has.alias("__has"), F.col(text).alias("__text")).mapInArrow(run, f"`{key}` {kind}, held_out boolean, lang_pred string, score double")
