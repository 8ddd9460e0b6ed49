"""Alignment of two tokenizers over a corpus, each distinct text once.

Documents are grouped by their full text. Every distinct text is tokenised by both vocabularies and its
tokens are aligned by their byte spans: offsets at which a token of both ends cut them into groups,
and two tokens whose spans overlap are a link. Both sides tile the same bytes, so the links are
the pieces between neighbouring token ends of either side. A pair of ids counts its links times the
number of documents with that text. Links are matched to the corpus's counts by blocks of texts: a
block asks once for each of its pairs, and its texts are scored where the answers meet it.
"""

from __future__ import annotations

import hashlib
import os
import sys
import unicodedata
import uuid
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramflow.llm.byte_bpe import code_points, piece_starts
from tramflow.llm.common import byte_letters, chunks, id_and_text, join_measures, ragged, text_bytes
from tramflow.llm.memo import Memo
from tramflow.session import ensure_checkpoint_dir

VOCABULARY_A = "byte_bpe_50k.json"
VOCABULARY_B = "piece_bpe_32k.model"
#: Text tokenised at once, and text of one block; a block asks for each of its pairs once.
CHUNK_BYTES = 1 << 20
BLOCK_BYTES = 8 << 20
LATIN = 0x250
MEASURES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


class Tokens:
    """Bytes of every id of a vocabulary, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[ragged(self.starts[ids], self.lengths[ids])]


class ByteLevel:
    """A byte-level vocabulary; strings of special tokens in a text are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        letters = byte_letters()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            tokens[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        self.tokens = Tokens(tokens)
        self.merges = Tokenizer(self.tokenizer.model)  # type: ignore[attr-defined]
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.letters = {byte: letter for letter, byte in letters.items()}
        self.memo = Memo(self._merged)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text behind a space, one text after the other, and row offsets into them.

        The vocabulary's pattern is matched by classes of characters, and each distinct match is merged once by the library. A text
        with characters that have changed their class since Unicode 3.2, so that libraries may not agree, is encoded whole.
        """
        data, offsets = text_bytes(pa.array([" " + t if t else "" for t in texts], pa.large_string()))
        points, at = code_points(data)
        table = unsettled(LATIN if points.max(initial=0) < LATIN else sys.maxunicode + 1)
        rows = np.searchsorted(offsets, at[np.flatnonzero(table[points])], side="right") - 1
        whole = np.zeros(len(texts), bool)
        whole[rows] = True
        begins = offsets[:-1][np.diff(offsets) > 0]
        starts = at[piece_starts(points, np.searchsorted(at, begins))] if len(data) else np.zeros(0, np.int64)
        lengths = np.diff(np.append(starts, len(data)))
        if whole.any():
            keep = ~whole[np.searchsorted(offsets, starts, side="right") - 1]
            starts, lengths = starts[keep], lengths[keep]
        ids, ends = self.memo.spans(data, starts, lengths)
        stops = ends[np.searchsorted(starts, offsets)]
        if not whole.any():
            return ids, stops
        made = iter(self.tokenizer.encode_batch_fast([" " + texts[i] for i in np.flatnonzero(whole)], add_special_tokens=False))
        return flat([np.array(next(made).ids, np.uint32) if w else ids[a:b] for w, a, b in zip(whole, stops[:-1], stops[1:], strict=True)])

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces are merged many at a time, by the letters of their bytes, and told apart by their lengths."""
        lines = [" ".join([p.decode("latin-1").translate(self.letters) for p in pieces[at : at + 64]]) for at in range(0, len(pieces), 64)]
        raw = b"".join(array("I", e.ids).tobytes() for e in self.merges.encode_batch_fast(lines, add_special_tokens=False))
        ends = np.cumsum(self.tokens.lengths[np.frombuffer(raw, "<u4")])
        stops = 4 * (np.searchsorted(ends, np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))) + 1)
        return [raw[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=True)]


class Pieces:
    """A piece vocabulary with byte fallback, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.processor.get_piece_size()
        self.tokens = Tokens([self._bytes(i) for i in range(n)])
        self.space = array("I", [self.processor.piece_to_id("▁")]).tobytes()
        # where no piece goes on from other characters to a space, spaces and what follows them are encoded apart
        self.apart = not any("▁" in self.processor.id_to_piece(i).lstrip("▁") for i in range(n))
        self.memo = Memo(self._units)

    def _bytes(self, i: int) -> bytes:
        piece = self.processor.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.processor.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each text behind the space that the vocabulary adds, one text after the other, and row offsets into them."""
        data, offsets = text_bytes(pa.array([" " + t if t else "" for t in texts], pa.large_string()))
        space = data == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        begins = offsets[:-1][np.diff(offsets) > 0]
        start[begins] = True
        whole = np.array([not self.apart or "▁" in t for t in texts], bool)
        starts = np.flatnonzero(start)
        if whole.any():
            row = np.searchsorted(offsets, starts, side="right") - 1
            starts = starts[~whole[row] | (starts == offsets[row])]
        ids, ends = self.memo.spans(data, starts, np.diff(np.append(starts, len(data))))
        return ids, ends[np.searchsorted(starts, offsets)]

    def _units(self, units: list[bytes]) -> list[bytes]:
        made = self.processor.encode([u[1:].decode() for u in units], num_threads=1)
        raw = array("I", chain.from_iterable(made)).tobytes()
        stops = list(accumulate(4 * len(ids) for ids in made))
        return [raw[a:b] if len(u) > 1 else self.space for u, a, b in zip(units, [0, *stops[:-1]], stops, strict=False)]


@lru_cache(maxsize=2)
def unsettled(n: int) -> np.ndarray:
    """True for those of the first ``n`` code points that are unassigned, or were in Unicode 3.2 or had another category there."""
    old, now = unicodedata.ucd_3_2_0.category, unicodedata.category
    return np.fromiter((now(c) == "Cn" or old(c) != now(c) for c in map(chr, range(n))), bool, n)


@lru_cache(maxsize=2)
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All ids one after the other, and row offsets into them."""
    return np.concatenate(rows), np.append(0, np.cumsum(np.fromiter(map(len, rows), np.int64, len(rows))))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each row's values."""
    total = np.append(0, np.cumsum(values))
    return total[offsets[1:]] - total[offsets[:-1]]


def spelled(ids: np.ndarray, offsets: np.ndarray, tokens: Tokens, wanted: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Whether each row's tokens, joined, are the row's wanted bytes."""
    sizes = sums(tokens.lengths[ids], offsets)
    same = sizes == np.diff(borders)
    rows = np.flatnonzero(same)
    have = tokens.joined(ids[ragged(offsets[rows], np.diff(offsets)[rows])])
    want = wanted[ragged(borders[rows], np.diff(borders)[rows])]
    wrong = np.flatnonzero(have != want)
    ends = np.cumsum(sizes[rows])
    same[rows[np.unique(np.searchsorted(ends, wrong, side="right"))]] = False
    return same


def counted(flags: np.ndarray) -> np.ndarray:
    """How many flags are set before each place."""
    return np.cumsum(flags) - flags


class Aligned:
    """Two tokenisations of the same rows of bytes, placed on one line: token ends, links and groups."""

    def __init__(self, a: np.ndarray, a_rows: np.ndarray, a_bytes: np.ndarray, b: np.ndarray, b_rows: np.ndarray, b_bytes: np.ndarray):
        self.a, self.b, self.a_rows, self.b_rows = a, b, a_rows, b_rows
        a_ends = np.cumsum(a_bytes)
        both = np.concatenate([a_ends, np.cumsum(b_bytes)])
        order = np.argsort(both, kind="stable")  # two sorted runs; of equal ends A's is first
        both, of_a = both[order], order < len(a)
        twice = np.append(both[1:] == both[:-1], False)[: len(both)]  # A's end, with B's behind it
        first = ~np.append(False, twice[:-1])[: len(both)]
        self.cut = twice[first]  # at every distinct end: whether both sides end there
        self.has_a, self.has_b = of_a[first], ~of_a[first] | self.cut
        self.link_a, self.link_b = counted(self.has_a), counted(self.has_b)
        row_ends = np.append(0, a_ends)[a_rows]
        self.link_rows = np.searchsorted(both[first], row_ends, side="right")
        self.group_rows = np.append(0, np.cumsum(self.cut))[self.link_rows]

    def pairs(self) -> np.ndarray:
        """Both ids of each link in one number."""
        return self.a[self.link_a] << 32 | self.b[self.link_b]

    def written(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows' groups in text, ``a1,a2|b1;a3|b2,b3``, one row after the other, and row offsets into them."""
        group = counted(self.cut)
        a_group, b_group = group[self.has_a], group[self.has_b]
        # a group's A ids follow the B ids of all earlier groups, and its B ids its own and earlier A ids
        a_at = np.arange(len(self.a)) + np.append(0, (self.link_b + 1)[self.cut])[a_group]
        b_at = np.arange(len(self.b)) + (self.link_a + 1)[self.cut][b_group]
        n = len(self.a) + len(self.b)
        ids, after = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        ids[a_at], ids[b_at] = self.a, self.b
        after[a_at[np.append(a_group[1:] != a_group[:-1], True)[: len(a_at)]]] = ord("|")
        after[b_at[np.append(b_group[1:] != b_group[:-1], True)[: len(b_at)]]] = ord(";")
        digits, used = decimals(int(ids.max(initial=0)))
        wide = np.empty((n, digits.shape[1] + 1), np.uint8)
        wide[:, :-1], wide[:, -1] = digits[ids], after
        keep = used[ids]
        stops = np.append(0, np.cumsum(keep.sum(axis=1)))
        return wide[keep], stops[self.a_rows + self.b_rows]


@lru_cache(maxsize=2)
def _decimals(places: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = np.arange(10**places)
    digits = numbers[:, None] // 10 ** np.arange(places - 1, -1, -1) % 10
    used = numbers[:, None] >= 10 ** np.arange(places - 1, -1, -1)
    used[:, -1] = True
    return (digits + ord("0")).astype(np.uint8), np.append(used, np.ones((len(numbers), 1), bool), axis=1)


def decimals(largest: int) -> tuple[np.ndarray, np.ndarray]:
    """Right-aligned decimal digits of all numbers of as many places as ``largest``, and which are written, with one place more for a mark."""
    return _decimals(len(str(largest)))


def tokenised(part: pa.RecordBatch, path_a: str, path_b: str) -> Aligned:
    """Both tokenisations of the texts; a row without tokens is empty or not spelled by one of the vocabularies."""
    first, second = byte_level(path_a), pieces(path_b)
    texts = part.column("text").to_pylist()
    wanted, borders = text_bytes(pa.array([" " + t if t else "" for t in texts], pa.large_string()))
    (a, a_rows), (b, b_rows) = first.encode(texts), second.encode(texts)
    a, b = a.astype(np.int64), b.astype(np.int64)
    good = spelled(a, a_rows, first.tokens, wanted, borders) & spelled(b, b_rows, second.tokens, wanted, borders)

    def of_good(ids: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.where(good, np.diff(rows), 0)
        return ids[ragged(rows[:-1], sizes)], np.append(0, np.cumsum(sizes))

    (a, a_rows), (b, b_rows) = of_good(a, a_rows), of_good(b, b_rows)
    return Aligned(a, a_rows, first.tokens.lengths[a], b, b_rows, second.tokens.lengths[b])


def tokenise_distinct(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows of each distinct text and of each block's pairs; ``key`` is the SHA-256 of the text, null in rows of pairs.

    A text row has its number of documents ``n``, its own measures and, in ``links``, the place of each link's pair in
    its block's list. A pair row has its place ``at``, the two ids in one number and, in ``n``, its links in the
    block, each as often as there are documents with its text.
    """
    distinct = docs.groupBy("text").agg(F.count(F.lit(1)).alias("n")).withColumn("key", F.unhex(F.sha2("text", 256)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32  # type: ignore[union-attr]
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for part in chunks(batch, limit=min(CHUNK_BYTES, block_bytes)):
                lines = tokenised(part, path_a, path_b)
                text, borders = lines.written()
                raw = text.tobytes()
                # the last group's semicolon is no part of the text
                hashes = [hashlib.sha256(raw[s : e - 1]).digest() if e > s else None for s, e in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]
                own = [np.diff(x) for x in (lines.a_rows, lines.b_rows, lines.group_rows, lines.link_rows)]
                held.append((part.column("key"), part.column("n"), own, hashes, lines.pairs(), lines.link_rows))
                size += part.column("text").nbytes
                if size >= block_bytes:
                    yield from rows_of(block, held)
                    block, held, size = block + 1, [], 0
        if held:
            yield from rows_of(block, held)

    def rows_of(block: int, held: list[tuple]) -> Iterator[pa.RecordBatch]:
        at, pairs = pd.factorize(np.concatenate([h[4] for h in held]))
        weights, at = np.zeros(len(pairs), np.int64), at.astype("<u4")
        done = 0
        for key, n, own, hashes, links, rows in held:
            here = at[done : done + len(links)]
            done += len(links)
            times = np.asarray(n)
            np.add.at(weights, here, np.repeat(times, np.diff(rows)))
            raw = here.tobytes()
            packed = [raw[4 * s : 4 * e] for s, e in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True)]
            columns = [key, n, *map(pa.array, own), pa.array(hashes, pa.binary()), pa.array(packed, pa.binary())]
            yield batch_of(block, len(key), dict(zip(text_columns, columns, strict=True)))
        for s in range(0, len(pairs), 1 << 16):
            some = slice(s, s + (1 << 16))
            n = len(pairs[some])
            yield batch_of(block, n, {"at": pa.array(np.arange(s, s + n)), "pair": pa.array(pairs[some]), "n": pa.array(weights[some])})

    def batch_of(block: int, n: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(n, block))
        return pa.RecordBatch.from_arrays([columns.get(name, pa.nulls(n, kind)) for name, kind in fields], [name for name, _ in fields])

    text_columns = ["key", "n", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]
    long, binary = pa.int64(), pa.binary()
    fields = [("block", long), ("key", binary), ("n", long), ("n_a", long), ("n_b", long), ("n_groups", long), ("n_links", long), ("groups", binary), ("links", binary), ("at", long), ("pair", long)]
    return distinct.mapInArrow(run, ", ".join(f"{name} {'long' if kind == long else 'binary'}" for name, kind in fields))


def pair_counts(made: DataFrame) -> DataFrame:
    """``pair, count, best``: the links that hold each pair over all documents, and whether its B id has no pair with more.

    There are no more B ids than vocabulary entries, so their highest counts are broadcast.
    """
    counts = made.where("key IS NULL").groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return counts.join(F.broadcast(top), "b").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """The texts of one block with the sums over their links of the pairs' counts."""
    n = len(answers)
    count, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = np.asarray(answers.column("at"))
    count[at], best[at] = np.asarray(answers.column("count")), np.asarray(answers.column("best")).astype(np.int64)
    links = [np.frombuffer(x.as_py(), "<u4") for x in texts.column("links")]
    offsets = np.append(0, np.cumsum(np.fromiter(map(len, links), np.int64, len(links))))
    joined = np.concatenate(links) if links else np.zeros(0, np.uint32)
    out = texts.select(["key", "n", "n_a", "n_b", "n_groups", "n_links", "groups"])
    return out.append_column("n_best", pa.array(sums(best[joined], offsets))).append_column("count_sum", pa.array(sums(count[joined], offsets)))


def aligned(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every row.

    ``path_a`` names a byte-level vocabulary and ``path_b`` a piece vocabulary that every executor has.
    A text that is null, empty or not spelled exactly by both has no tokens: zeros and an empty hash. A
    repeated row counts again and gives a repeated row; ``n_best`` counts all pairs of equal highest count. An
    empty table gives no rows. Columns but ``doc_id`` and ``text`` are not read.
    """
    folder = f"{ensure_checkpoint_dir(docs.sparkSession)}/token-align-{uuid.uuid4().hex}"
    read = docs.sparkSession.read.parquet
    docs = id_and_text(docs)
    tokenise_distinct(docs, path_a, path_b, block_bytes).write.parquet(f"{folder}/made")
    made, texts = read(f"{folder}/made"), read(f"{folder}/made").where("key IS NOT NULL").drop("at", "pair")
    answers = made.where("key IS NULL").select("block", "at", "pair").join(pair_counts(made), "pair").select("block", "at", "count", "best")
    schema = "key binary, n long, n_a long, n_b long, n_groups long, n_links long, groups binary, n_best long, count_sum long"
    texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, schema).write.parquet(f"{folder}/measures")
    keyed = docs.select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"))
    out = join_measures(keyed, read(f"{folder}/measures"), "key", "n")
    return out.select("doc_id", *MEASURES, F.coalesce(F.lower(F.hex("groups")), F.lit("")).alias("groups_sha256"))
