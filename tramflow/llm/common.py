"""What the operators of this subpackage share: input columns, text chunks, word ids."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII blanks (fixed by the result contract).
WORD = r"[^\x20\x09-\x0D]+"
BLANK = r"[\x20\x09-\x0D]+"

#: Text handed to numpy at once, so a task's memory does not depend on batch or document counts.
CHUNK_BYTES = 2 << 20

#: No table has more keys than this with over one part in this many of its rows each.
HEAVY_KEYS = 10_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table, whole."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``labels`` table, whole."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone, a null text as an empty one; other columns, clashing or not, are left out."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def chunks(batch: pa.RecordBatch, column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each; one longer text is a slice of its own."""
    sizes = np.asarray(pa.compute.binary_length(batch.column(column)).fill_null(0), dtype=np.int64)
    start = total = 0
    for row, n in enumerate(sizes):
        if row > start and total + n > limit:
            yield batch.slice(start, row - start)
            start, total = row, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column as one uint8 array and row offsets into it (nulls count as empty)."""
    column = pa.array(column.fill_null(""), pa.large_string()) if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of all spans (start, length), one span after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit integer over all its bits (xor-shift and multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=8)
def byte_table(seed: int) -> np.ndarray:
    """256 seeded 64-bit values, one for each byte."""
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word (``WORD``) of the texts in ``data``; no word crosses texts."""
    blank = np.ones(len(data) + 1, bool)
    blank[:-1] = (data == 32) | ((data >= 9) & (data <= 13))
    first = ~blank
    first[1:] &= blank[:-1]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    first[edges] = ~blank[edges]
    last = ~blank
    last[:-1] &= blank[1:]
    last[edges - 1] = ~blank[edges - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 1) -> np.ndarray:
    """64-bit hash of the bytes of each span: a sum of seeded byte values times odd powers, mixed."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    flat = ragged(starts, lengths)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    values = byte_table(seed)[data[flat]] * powers(int(lengths.max()))[at]
    sums = np.add.reduceat(values, np.cumsum(lengths) - lengths)
    return mix64(sums + lengths.astype(np.uint64))


@lru_cache(maxsize=2)
def _powers(n: int) -> np.ndarray:
    base = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    base[0] = 1
    return np.multiply.accumulate(base)


def powers(n: int) -> np.ndarray:
    """Powers 0..n-1 of an odd 64-bit base."""
    size = 1024
    while size < n:
        size *= 4
    return _powers(size)[:n]


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte: itself, or the next free one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that no model learns from: crc32 of the id as text, mod 3, is 1. A null id is in it."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(True))


def training_rows(docs: DataFrame, marks: DataFrame, column: str, per_class: int, max_chars: int) -> DataFrame:
    """``doc_id, text, lang, label`` of a bounded training sample outside the held-out fold.

    The ``per_class`` ids of each class with the smallest hashes are taken; of their texts those
    of at most ``max_chars`` code points, and no more rows than ids. Null labels are left out; of
    repeated labels of one id the largest holds. The chosen ids are few enough to broadcast.
    """
    known = marks.where(F.col(column).isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(column).cast("int").alias("label"))
    parts = [known.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for v in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *(["lang"] if "lang" in docs.columns else []))
    return texts.where(F.char_length("text") <= max_chars).join(chosen, "doc_id").limit(2 * per_class)



def join_measures(rows: DataFrame, measures: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` with the columns of ``measures``, which has one row per ``key`` (a null is a key too) and its number of rows in ``count``.

    A key that holds more than a ten-thousandth of all rows is heavy. There are fewer than
    ``HEAVY_KEYS`` such keys in any table, so their measures are broadcast; the rows of all other
    keys are shuffled, and no task gets more than that share of them for one key. ``measures`` should be
    a written table: it is read three times. ``rows`` are computed twice.
    """
    total = measures.agg(F.coalesce(F.sum(count), F.lit(0))).first()[0]  # type: ignore[index]
    measures = measures.withColumnRenamed(key, "_key").withColumn("_heavy", F.col(count) > F.lit(total // HEAVY_KEYS))
    heavy = F.broadcast(measures.where("_heavy"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    light = rows.join(heavy.select("_key"), same, "left_anti").join(measures.where("NOT _heavy"), same)
    return rows.join(heavy, same).unionByName(light).drop("_key", "_heavy", count)
