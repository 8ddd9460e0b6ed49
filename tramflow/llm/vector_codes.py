"""Vector code compression: integer codebooks by part, searched in the Walsh-Hadamard domain.

Components become integers and a vector is cut into equal parts, each with a codebook of its own. A part
and the entries, padded with zeros to a power of two m, are transformed by integer additions alone. The
transform keeps squared distances up to the factor m, so squared differences of coefficients, taken in
order of sequency, add up to m times the distance. An entry whose sum exceeds the whole distance
of another can't be the nearest and is left. No step uses floating point.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from decimal import Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramflow.llm.common import join_measures
from tramflow.session import ensure_checkpoint_dir

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: A component at or beyond this is treated like an infinite one; its integer would not fit in 64 bits.
LARGEST = 2.0**62 / SCALE
#: Components handed to numpy at once.
SLICE = 1 << 20
LONG = 2**63


def kept(column: str) -> Column:
    """True for vectors that are not null and whose components are all present and finite (and below ``LARGEST``)."""
    fits = F.forall(column, lambda x: F.coalesce(F.abs(x) < LARGEST, F.lit(False)))
    return F.coalesce(fits, F.lit(False))


def integers(column: pa.Array, width: int) -> np.ndarray:
    """Floors of the scaled components, a row per vector; vectors shorter than ``width`` are padded with zeros."""
    sizes = np.asarray(pa.compute.list_value_length(column), np.int64)
    out = np.zeros((len(column), width), np.int64)
    # the factor is a power of two, so a double holds the product exactly
    out[np.arange(width) < sizes[:, None]] = np.floor(np.asarray(column.flatten(), np.float64) * SCALE).astype(np.int64)
    return out


@lru_cache(maxsize=8)
def sequency(m: int) -> np.ndarray:
    """Rows of the Hadamard matrix of size m by their number of sign changes."""
    at = np.arange(m)
    ones = np.array([[bin(i & j).count("1") & 1 for j in at] for i in at]).reshape(m, m)
    return np.argsort((np.diff(ones, axis=1) != 0).sum(axis=1), kind="stable")


def transformed(rows: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of each row, padded with zeros to a power of two, in order of sequency."""
    m = 1 << max(rows.shape[1] - 1, 0).bit_length()
    out = np.zeros((len(rows), m), rows.dtype)
    out[:, : rows.shape[1]] = rows
    h = 1
    while h < m:
        pairs = out.reshape(len(rows), m // (2 * h), 2, h)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(rows), m)
        h *= 2
    return out[:, sequency(m)]


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, the lower of equals, and the squared distance.

    Beside int64 arrays this takes arrays of Python's integers, for components whose squares would not fit.
    """
    rows, entries = transformed(parts), transformed(book)
    m = rows.shape[1]
    row, entry = np.divmod(np.arange(len(rows) * len(entries)), len(entries))
    sums = (rows[row, 0] - entries[entry, 0]) ** 2
    bound = None
    for c in range(1, m + 1):
        if c == m or c & (c - 1) == 0:  # lower the bound: the whole distance of the row's best so far
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            least = np.repeat(np.minimum.reduceat(sums, first), np.diff(np.append(first, len(row))))
            at = np.flatnonzero(sums == least)
            at = at[np.append(True, row[at[1:]] != row[at[:-1]])]
            if c == m:
                return entry[at], sums[at] // m
            whole = ((rows - entries[entry[at]]) ** 2).sum(axis=1)
            bound = whole if bound is None else np.minimum(bound, whole)
        alive = (sums <= bound[row]).astype(bool)
        if not alive.all():
            row, entry, sums = row[alive], entry[alive], sums[alive]
        sums = sums + (rows[row, c] - entries[entry, c]) ** 2
    raise AssertionError("unreachable")


def fitting(values: np.ndarray, books: list[list[list[int]]], width: int) -> np.ndarray:
    """The values as int64 where no scaled distance can exceed it, else as Python's integers."""
    m = 1 << max(width - 1, 0).bit_length()
    top = max(int(np.abs(values).max(initial=0)), max((abs(x) for book in books for entry in book for x in entry), default=0))
    return values if m**3 * (2 * top) ** 2 < LONG // 2 else values.astype(object)


def slices(batch: pa.RecordBatch, books: list[list[list[int]]], width: int) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    """Slices of a batch, with the parts, the entries assigned and the distances of each part position."""
    step = max(1, SLICE // (PARTS * max(width, 4 * ENTRIES)))
    for start in range(0, len(batch), step):
        some = batch.slice(start, step)
        values = fitting(integers(some.column("embedding"), PARTS * width), books, width)
        parts = [values[:, p * width : (p + 1) * width] for p in range(PARTS)]
        yield some, [(x, *nearest(x, np.array(book, values.dtype).reshape(len(book), width))) for x, book in zip(parts, books, strict=True)]


def refined(vectors: DataFrame, books: list[list[list[int]]], width: int) -> list[list[list[int]]]:
    """The codebooks after one round. Tasks add up the parts of each entry, and at most one row per entry and component comes back."""
    size = len(books[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros((PARTS, size, width), object), np.zeros((PARTS, size), np.int64)
        for batch in batches:
            for _, found in slices(batch, books, width):
                for p, (parts, entry, _) in enumerate(found):
                    order = np.argsort(entry, kind="stable")
                    used, first = np.unique(entry[order], return_index=True)
                    totals[p, used] += np.add.reduceat(parts[order].astype(object) if parts.dtype == object else parts[order], first, axis=0)
                    counts[p] += np.bincount(entry, minlength=size)
        p, e = np.nonzero(counts)
        n = len(p) * width
        columns = [np.repeat(p, width), np.repeat(e, width), np.tile(np.arange(width), len(p)), np.repeat(counts[p, e], width)]
        sums = pa.array([Decimal(int(x)) for x in totals[p, e].ravel()], pa.decimal128(38, 0))
        if n:
            yield pa.RecordBatch.from_arrays([*(pa.array(c.astype(np.int64)) for c in columns), sums], ["part", "entry", "at", "n", "total"])

    partial = vectors.select("embedding").mapInArrow(run, "part long, entry long, at long, n long, total decimal(38,0)")
    out = [[list(entry) for entry in book] for book in books]
    for r in partial.groupBy("part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        out[r.part][r.entry][r.at] = int(r.total) // r.n
    return out


def codebooks(vectors: DataFrame) -> tuple[list[list[list[int]]], int]:
    """Codebooks by part, entry and position, and the width of a part."""
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0  # type: ignore[index]
    width = -(-longest // PARTS)
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(ENTRIES).toArrow()["embedding"].combine_chunks()
    rows = integers(first, PARTS * width).tolist()
    books = [[row[p * width : (p + 1) * width] for row in rows] for p in range(PARTS)]
    for _ in range(ROUNDS if rows and width else 0):
        books = refined(vectors, books, width)
    return books, width


def coded(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` of every row whose vector is kept (see ``kept``).

    Expects ``vec_id``, ``embedding`` and ``label``; other columns are not read. Rows of one ``vec_id`` are rows of their own,
    in the order of their vectors where the first entries are chosen; a null ``vec_id`` is last. With fewer vectors
    than entries the codebooks have fewer. Vectors shorter than the longest, or a length that is no multiple of
    ``PARTS``, are padded with zeros. A null ``label`` is a label too. Errors that no long holds are null. A table
    without a kept vector gives no rows. All arithmetic is by integers of 64 bits or, where they could overflow, by Python's.
    """
    folder = f"{ensure_checkpoint_dir(vectors.sparkSession)}/vector-codes-{uuid.uuid4().hex}"
    vectors = vectors.where(kept("embedding")).select("vec_id", "label", "embedding")
    books, width = codebooks(vectors)
    kinds = dict(vectors.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, found in slices(batch, books, width):
                codes = np.stack([entry for _, entry, _ in found], axis=1).astype(np.uint8)
                hexed = codes.tobytes().hex()
                error = sum(distance for _, _, distance in found).tolist()  # type: ignore[union-attr]
                columns = [pa.array([hexed[2 * PARTS * i : 2 * PARTS * (i + 1)] for i in range(len(some))], pa.string()), pa.array([x if x < LONG else None for x in error], pa.int64())]
                yield pa.RecordBatch.from_arrays([some.column("vec_id"), some.column("label"), *columns], ["vec_id", "label", "code", "error"])

    vectors.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long").write.parquet(f"{folder}/codes")
    codes = vectors.sparkSession.read.parquet(f"{folder}/codes")
    codes.groupBy("label").agg(F.try_sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")).write.parquet(f"{folder}/labels")
    out = join_measures(codes, vectors.sparkSession.read.parquet(f"{folder}/labels"), "label", "n")
    text = ",".join(str(x) for book in books for entry in book for x in entry)
    return out.select("vec_id", "code", "error", "label_error", F.lit(hashlib.sha256(text.encode()).hexdigest()).alias("codebooks_sha256"))
