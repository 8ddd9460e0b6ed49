"""Byte-level BPE: encoding and decoding with a public vocabulary, in numpy inside Spark tasks.

A task takes a chunk of whole texts. Code points are classed by tables and the pieces that
the vocabulary's pattern would match are found from the classes' runs. Equal pieces are
encoded once: their bytes become rows of padded matrices, one matrix per length
bucket, and in each round every row merges its leftmost pair of minimum rank, looked up
in a hash table of pairs, and is compacted. Rows without a pair leave the matrix.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from tramflow.llm.common import chunks, id_and_text, mix64, ragged, text_bytes

VOCABULARY = "byte_bpe_50k.tiktoken"
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: Unicode white space (fixed values).
WHITE = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: Pieces kept per worker, so that a frequent word is merged once in a task; a memo alone.
MEMO_PIECES = 400_000
PADS = (4, 8, 12, 16, 24, 32, 48, 64)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point: letter, number, white space or other."""
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    out[list(WHITE)] = SPACE
    return out


class Vocabulary:
    """Ranks of a byte-level vocabulary file: the pair table, byte tokens and the bytes of each id."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in ranks.items():
            tokens[rank] = token
        self.ranks = ranks
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        pairs = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        left, right, rank = np.array(pairs, np.int64).T
        self._hash(left, right, rank)
        self.memo: dict[bytes, np.ndarray] = {}

    def _hash(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> None:
        """Open addressing with linear probes; a quarter full, so that probes are short."""
        keys = (left << 32 | right).astype(np.uint64)
        self.bits = int(np.ceil(np.log2(4 * len(keys))))
        self.keys = np.full(1 << self.bits, EMPTY)
        self.values = np.full(1 << self.bits, -1, np.int32)
        slot = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[slot[todo]] == EMPTY]
            self.keys[slot[free]] = keys[free]
            placed = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[placed]] = rank[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, or a large number where it is none."""
        none = np.int32(2**31 - 1)
        keys = (left.astype(np.int64) << 32 | right).astype(np.uint64).ravel()
        out = np.full(keys.shape, none, np.int32)
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            found = self.keys[slot]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (found != EMPTY)
            todo, slot = todo[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out.reshape(left.shape)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Token ids of each piece, merged in padded matrices by length bucket."""
        out: list[np.ndarray | None] = [None] * len(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        top = max(int(sizes.max()), 1)
        pads = [*(p for p in PADS if p < top), *(64 << i for i in range(1, 64) if 64 << i < top), top]
        bucket = np.searchsorted(pads, sizes)
        for b in np.unique(bucket):
            rows = np.flatnonzero(bucket == b)
            step = max(1, (1 << 21) // pads[b])
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                data = np.frombuffer(b"".join(pieces[i] for i in some), np.uint8)
                wide = np.full((len(some), pads[b]), -1, np.int64)
                wide[np.arange(pads[b]) < sizes[some][:, None]] = self.byte_ids[data]
                for i, ids in zip(some, self._rounds(wide, sizes[some].copy()), strict=True):
                    out[i] = ids
        return out  # type: ignore[return-value]

    def _rounds(self, ids: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
        """One merge in every row and round; a row's pair ranks are kept and renewed only beside the merge."""
        done: list[np.ndarray | None] = [None] * len(ids)
        none = np.int32(2**31 - 1)
        alive = np.arange(len(ids))
        width = ids.shape[1]
        ranks = np.full(ids.shape, none, np.int32)
        if width > 1:
            ok = ids[:, 1:] >= 0
            ranks[:, :-1][ok] = self.pair_ranks(ids[:, :-1][ok], ids[:, 1:][ok])
        while True:
            best = ranks.argmin(axis=1)  # the first of equal ranks: the leftmost
            row = np.arange(len(ids))
            rank = ranks[row, best]
            over = rank == none
            if over.any():
                for r in np.flatnonzero(over):
                    done[alive[r]] = ids[r, : sizes[r]].astype(np.uint32)
                keep = ~over
                if not keep.any():
                    return done  # type: ignore[return-value]
                ids, ranks, sizes, alive, best, rank = ids[keep], ranks[keep], sizes[keep], alive[keep], best[keep], rank[keep]
                row = np.arange(len(ids))
                if sizes.max() < width // 2:
                    width = int(sizes.max())
                    ids, ranks = ids[:, :width].copy(), ranks[:, :width].copy()
            gone = np.ones(ids.shape, bool)
            gone[row, best + 1] = False
            ids[row, best] = rank
            ids = np.concatenate([ids[gone].reshape(len(ids), width - 1), np.full((len(ids), 1), -1, np.int64)], axis=1)
            ranks = np.concatenate([ranks[gone].reshape(len(ids), width - 1), np.full((len(ids), 1), none, np.int32)], axis=1)
            sizes -= 1
            for at in (best - 1, best):
                r = row[(at >= 0) & (at + 1 < sizes)]
                a = at[r]
                ranks[r, a] = self.pair_ranks(ids[r, a], ids[r, a + 1])
            r = row[best + 1 >= sizes]
            ranks[r, best[r]] = none

    def encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        new = [p for p in pieces if p not in self.memo]
        if len(self.memo) + len(new) > MEMO_PIECES:
            self.memo.clear()
            new = pieces
        if new:
            self.memo.update(zip(new, self.merge(new), strict=True))
        memo = self.memo
        return [memo[p] for p in pieces]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the ids, one after the other."""
        return self.bytes[ragged(self.starts[ids], self.lengths[ids])]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes and the byte at which each starts."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[starts].astype(np.uint32)
    out = lead.copy()
    for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        many = np.flatnonzero(lead >= low) if size > 2 else np.flatnonzero((lead >= 0xC0) & (lead < 0xE0))
        if size == 3:
            many = many[lead[many] < 0xF0]
        value = lead[many] & mask
        for k in range(1, size):
            value = value << 6 | (data[starts[many] + k] & 0x3F)
        out[many] = value
    return out, starts


def piece_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Where the pattern's matches begin, as indexes of code points; ``text_starts`` are those of the texts.

    A match is a run of one class with one blank before it, if that blank is U+0020. White space
    before something else gives its last character to what follows, alone if it is no
    U+0020. An apostrophe that begins a match splits off s, t, re, ve, m, ll or d.
    """
    n = len(points)
    kind = char_classes()[points]
    border = np.zeros(n + 1, bool)
    border[text_starts] = True
    border[n] = True
    start = border[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = space.copy()  # the last white character before something else in the same text
    last[:-1] &= ~space[1:] & ~border[1:n]
    last[-1:] = False
    start |= last
    taken = np.flatnonzero(last & (points == 32)) + 1
    start[taken] = False
    quote = np.flatnonzero(points == 39)
    quote = quote[start[quote]]
    text_end = np.append(np.flatnonzero(border)[1:], n)
    room = text_end[np.searchsorted(text_end, quote, side="right")] - quote
    padded = np.append(points, [0, 0])
    a, b = padded[quote + 1], padded[quote + 2]
    one = np.isin(a, [ord(c) for c in "stmd"])
    two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
    size = np.where(one & (room >= 2), 1, np.where(two & (room >= 3), 2, 0))
    cut = quote[size > 0]
    size = size[size > 0]
    start[cut + 1] = False
    after = cut + 1 + size
    after = after[after < n]
    start[after] = True
    return np.flatnonzero(start)


def unique_pieces(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code of every span by its bytes, exactly, and a span that has each code; eight bytes at a time."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded, (len(data) + 1, 8), (1, 1))
    codes = lengths.astype(np.int64)
    codes, _ = pd.factorize(codes)
    todo = np.arange(len(starts))
    at = 0
    while len(todo):
        left = np.minimum(lengths[todo] - at, 8)
        word = np.ascontiguousarray(words[starts[todo] + at]).view(np.uint64).ravel()
        word &= np.where(left < 8, (np.uint64(1) << (np.uint64(8) * left.astype(np.uint64) % np.uint64(64))) - np.uint64(1), EMPTY)
        part, seen = pd.factorize(word)
        joined, _ = pd.factorize(codes[todo] * np.int64(len(seen)) + part)
        codes[todo] = joined + (0 if len(todo) == len(starts) else int(codes.max()) + 1)
        at += 8
        todo = todo[lengths[todo] > at]
    codes, _ = pd.factorize(codes)
    first = np.full(int(codes.max()) + 1 if len(codes) else 0, -1, np.int64)
    first[codes[::-1]] = np.arange(len(codes))[::-1]
    return codes, first


def encode_texts(column: pa.Array, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts of a column, one after the other, and row offsets into them."""
    data, offsets = text_bytes(column)
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
    points, at = code_points(data)
    begins = np.unique(offsets[:-1][np.diff(offsets) > 0])
    starts = at[piece_starts(points, np.searchsorted(at, begins))]
    lengths = np.diff(np.append(starts, len(data)))
    codes, first = unique_pieces(data, starts, lengths)
    raw = data.tobytes()
    pieces = [raw[s:e] for s, e in zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist(), strict=True)]
    merged = vocab.encode_pieces(pieces)
    sizes = np.fromiter(map(len, merged), np.int64, len(merged))
    ids = np.concatenate(merged)[ragged((np.cumsum(sizes) - sizes)[codes], sizes[codes])]
    ends = np.append(0, np.cumsum(sizes[codes]))
    return ids, ends[np.searchsorted(starts, offsets)]


def encoded(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every row, and the ``ids`` on request.

    The whole text is encoded, then the ids are decoded and the bytes hashed. ``path`` names a rank
    file that every executor has. A null text counts as empty: no ids, and the hash of no bytes.
    Repeated rows give repeated rows; columns but ``doc_id`` and ``text`` are not read.
    """
    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * with_ids
    docs = id_and_text(docs)
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for part in chunks(batch):
                ids, ends = encode_texts(part.column("text"), vocab)
                raw = vocab.decode(ids)
                stops = np.append(0, np.cumsum(vocab.lengths[ids]))[ends]
                spans = list(zip(ends[:-1].tolist(), ends[1:].tolist(), stops[:-1].tolist(), stops[1:].tolist(), strict=True))
                little = ids.astype("<u4")
                columns = [
                    part.column("doc_id"),
                    pa.array(np.diff(ends)),
                    pa.array([hashlib.sha256(little[a:b]).hexdigest() for a, b, _, _ in spans], pa.string()),
                    pa.array([hashlib.sha256(raw[c:d]).hexdigest() for _, _, c, d in spans], pa.string()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *(name for name, _ in fields)])

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return docs.mapInArrow(run, schema)
