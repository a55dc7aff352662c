"""Token ids of whole texts by a public tokenizer, many texts at once.

A byte-level BPE never joins a character with a blank that follows it, so a text may be cut
before every blank that follows a character that isn't white space: the segments' ids, put one
after the other, are the ids of the text. A block of texts is cut by places in its bytes and its
distinct segments are found by Arrow, so each reaches the tokenizer once a block: many at once, as
one text that is cut by the byte lengths of its tokens. Nothing is remembered between blocks.

The vocabulary is the tokenizer's own file, and the ids are those of ``Tokenizer.encode`` without
added special tokens: the name of a special token in a text is that token. If the file's merges
are ranked by id (as in a byte-level BPE of that family) segments go through the faster of the two
public libraries that read it; texts that name a special token, and all texts for another kind of
file, go whole through the other.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut and numbered at once.
BLOCK_BYTES = 16 << 20
#: Segments that are encoded as one text.
JOINED = 8192


def ranked(path: str):
    """A tiktoken encoding of a byte-level BPE file whose merges are in the order of their ids; else None."""
    import public_tokenizers
    import tiktoken

    whole = json.load(open(path, encoding="utf-8"))
    model, pre = whole["model"], whole.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or whole.get("normalizer"):
        return None
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes written as themselves
    rest = [b for b in range(256) if b not in plain]
    letter = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
    special = {t["content"] for t in whole.get("added_tokens", [])}
    ranks = {bytes(letter[c] for c in t): i for t, i in model["vocab"].items() if t not in special}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"][a + b] for a, b in merges]
    if any(x >= y for x, y in zip(order, order[1:])):
        return None
    return tiktoken.Encoding(os.path.basename(path), pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def blanks_to_cut_at(raw: np.ndarray) -> np.ndarray:
    """Places of blanks whose character before is surely no white space (UTF-8; a few others are left out, which loses nothing)."""
    at = np.flatnonzero(raw == 32)
    at = at[at > 0]
    one, two = raw[at - 1], raw[np.maximum(at - 2, 0)]
    white = (one <= 32) & ((one >= 28) | ((one >= 9) & (one <= 13)))
    white |= (one >= 0x80) & (((two == 0xC2) & ((one == 0x85) | (one == 0xA0))) | (two == 0x80) | (two == 0x81) | (two == 0x9A))
    return at[~white]


def large_binary(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of texts without nulls."""
    whole = texts.cast(pa.large_string() if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else pa.large_binary())
    offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    data = whole.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return offsets - offsets[0], raw[offsets[0] : offsets[-1]]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] of them), starts[1], ..."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = "|".join(map(re.escape, names))
        self.fast = ranked(path)
        if self.fast:
            self.width = np.zeros(self.fast.n_vocab, dtype=np.int64)
            for token in self.fast.token_byte_values():
                self.width[self.fast.encode_single_token(token)] = len(token)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and how many each has; none for a null."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        if not self.fast:
            whole = np.ones(len(texts), dtype=bool)
        elif self.specials:
            whole = pc.match_substring_regex(texts, self.specials).to_numpy(zero_copy_only=False)
        else:
            whole = np.zeros(len(texts), dtype=bool)
        if not whole.any():
            return self._segmented(texts)
        flat, sizes = self._segmented(texts.filter(pa.array(~whole)))
        alone = [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype=np.uint32) for t in texts.filter(pa.array(whole)).to_pylist()]
        all_ = np.zeros(len(texts), dtype=np.int64)
        all_[~whole], all_[whole] = sizes, [len(x) for x in alone]
        out, mine = np.zeros(int(all_.sum()), dtype=np.uint32), np.repeat(whole, all_)
        out[~mine], out[mine] = flat, np.concatenate(alone)
        return out, all_

    def _segmented(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        offsets, raw = large_binary(texts)
        parts, first = [], 0
        while first < len(texts):
            last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1)
            parts.append(self._block(offsets[first : last + 1] - offsets[first], raw[offsets[first] : offsets[last]]))
            first = last
        if not parts:
            return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)
        return tuple(map(np.concatenate, zip(*parts)))

    def _block(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        begins = np.zeros(len(raw) + 1, dtype=bool)
        begins[blanks_to_cut_at(raw)] = True
        begins[offsets] = True
        cut = np.flatnonzero(begins)
        if len(cut) < 2:
            return np.zeros(0, dtype=np.uint32), np.zeros(len(offsets) - 1, dtype=np.int64)
        segments = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut) - 1, [None, pa.py_buffer(cut), pa.py_buffer(raw)])
        coded = segments.dictionary_encode()
        store, start, size = self._distinct(*large_binary(coded.dictionary))
        code = coded.indices.to_numpy()
        each = size[code]
        upto = np.concatenate([[0], np.cumsum(each)])[np.searchsorted(cut, offsets)]
        return store[ragged(start[code], each)], np.diff(upto)

    def _distinct(self, offsets: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, and for each of these segments where its own begin and how many they are."""
        first, last = raw[offsets[:-1]], raw[offsets[1:] - 1]
        # joined, segments keep their ids if each starts with a blank (or comes after a line end of its own) and ends
        # with something else; bytes of control marks and of letters that may be white space count as such
        open_end = (last <= 32) | (last >= 0x80)
        blank, letter = first == 32, (first > 32) & (first < 0x80)
        start, size, out, total = np.zeros(len(first), dtype=np.int64), np.zeros(len(first), dtype=np.int64), [], 0
        safe = np.flatnonzero(open_end)
        ends_white = np.zeros(len(first), dtype=bool)
        ends_white[safe] = [raw[max(a, b - 4) : b].tobytes().decode(errors="ignore")[-1:].isspace() for a, b in zip(offsets[safe].tolist(), offsets[safe + 1].tolist())]
        for which, before in ((blank & ~ends_white, b""), (letter & ~ends_white, b"\n"), ((~blank & ~letter) | ends_white, None)):
            at = np.flatnonzero(which)
            step = JOINED if before is not None else 1
            for i in range(0, len(at), step):
                own = at[i : i + step]
                length = offsets[own + 1] - offsets[own]
                wide = length + len(before or b"")
                text = np.full(int(wide.sum()), 10, dtype=np.uint8)
                text[ragged(np.cumsum(wide) - length, length)] = raw[ragged(offsets[own], length)]
                ids = self.fast.encode_to_numpy(text.tobytes().decode(errors="replace")).astype("<u4")
                if before is None:
                    ends = np.array([len(ids)])
                else:
                    ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(wide)) + 1
                start[own] = total + np.concatenate([[0], ends[:-1]]) + len(before or b"")
                size[own] = total + ends - start[own]
                out.append(ids)
                total += len(ids)
        return np.concatenate(out), start, size


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def with_end(ids: np.ndarray, sizes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """An end id after each text's ids."""
    sizes = sizes + 1
    out = np.full(int(sizes.sum()), end, dtype="<u4")
    own = np.ones(len(out), dtype=bool)
    own[np.cumsum(sizes) - 1] = False
    out[own] = ids
    return out, sizes


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
