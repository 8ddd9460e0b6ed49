"""Document fingerprints: a quartile bucket digest and its bounded difference.

Byte triplets of a five-byte sliding window are hashed into 256 buckets. The digest keeps for
each bucket the quartile its count falls in (two bits), the length on a log scale and how the
quartiles relate. The difference of two digests adds bucket, length and ratio differences;
it is bounded, and likeness is one less its share of the bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramflow.llm.common import byte_table, chunks, id_and_text, text_bytes
from tramflow.session import ensure_checkpoint_dir

BUCKETS = 256
WINDOW = 5
#: Byte triplets of a window, as offsets from its first byte.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
HEADER = 3
#: The difference expected of independent quartiles; more than it counts as it.
BOUND = 416
#: Points for a bucket that is 0, 1, 2 or 3 quartiles away.
STEPS = np.array([0, 1, 2, 6], np.int32)


def digests(column: pa.Array) -> np.ndarray:
    """One row of ``HEADER + BUCKETS / 4`` bytes for each text; a null text counts as empty.

    A text is followed by zero bytes, so each of its bytes begins a window. An empty text has
    length 0 and all buckets in the lowest quartile.
    """
    data, offsets = text_bytes(column)
    n, lengths = len(column), np.diff(offsets)
    padded = np.zeros(len(data) + (WINDOW - 1) * n, np.uint8)
    row = np.repeat(np.arange(n), lengths)
    place = np.arange(len(data)) + row * (WINDOW - 1)
    padded[place] = data
    counts = np.zeros((n, BUCKETS), np.int64)
    base = row << 8
    for k, triplet in enumerate(TRIPLETS):
        hashed = np.zeros(max(len(padded) - WINDOW + 1, 0), np.uint8)
        for j, at in enumerate(triplet):
            table = (byte_table(97 * k + j) >> np.uint64(40)).astype(np.uint8)
            hashed ^= table[padded[at : at + len(hashed)]]
        counts += np.bincount(base | hashed[place], minlength=n * BUCKETS).reshape(n, BUCKETS)
    ordered = np.sort(counts, axis=1)
    q1, q2, q3 = (ordered[:, BUCKETS * k // 4 - 1] for k in (1, 2, 3))
    codes = ((counts > q1[:, None]).astype(np.uint8) + (counts > q2[:, None]) + (counts > q3[:, None])).reshape(n, -1, 4)
    out = np.zeros((n, HEADER + BUCKETS // 4), np.uint8)
    out[:, 0] = np.minimum(np.floor(np.log1p(lengths) / np.log(1.1)), 255)
    top = np.maximum(q3, 1)
    out[:, 1], out[:, 2] = 15 * q1 // top, 15 * q2 // top
    out[:, HEADER:] = codes[:, :, 0] << 6 | codes[:, :, 1] << 4 | codes[:, :, 2] << 2 | codes[:, :, 3]
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """1 for equal digests, 0 at ``BOUND`` points of difference or more; row by row."""
    a16, b16 = a.astype(np.int32), b.astype(np.int32)
    points = np.minimum(np.abs(a16[:, 0] - b16[:, 0]), 24) + np.abs(a16[:, 1:HEADER] - b16[:, 1:HEADER]).sum(axis=1)
    for shift in (6, 4, 2, 0):
        points += STEPS[np.abs((a16[:, HEADER:] >> shift & 3) - (b16[:, HEADER:] >> shift & 3))].sum(axis=1)
    return 1.0 - np.minimum(points, BOUND) / BOUND


def fixed_binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer((np.arange(len(rows) + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` (lowercase hex) of every row's text."""
    docs = id_and_text(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), fixed_binary(digests(part.column("text")))], ["doc_id", "fingerprint"])

    made = docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, fingerprint binary")
    return made.withColumn("fingerprint", F.lower(F.hex("fingerprint")))


def _rows(ids: pa.Array, texts: list[str], next_texts: list[str], next_digests: np.ndarray | None = None) -> list[pa.Array]:
    """The columns of ``edit_study`` for texts and the ones that follow them."""
    edited = []
    for text, after in zip(texts, next_texts, strict=True):
        k = len(text) // 4
        edited.append(text[: len(text) - k] + after[:k])
    own, other = digests(pa.array(texts, pa.large_string())), digests(pa.array(edited, pa.large_string()))
    if next_digests is None:
        next_digests = digests(pa.array(next_texts, pa.large_string()))
    else:
        next_digests = np.concatenate([own[1:], next_digests])
    sha = b"".join(hashlib.sha256(x.encode()).digest() for x in edited)
    sha = np.frombuffer(sha, np.uint8).reshape(-1, 32)
    return [ids, pa.array([len(x) for x in texts], pa.int64()), fixed_binary(sha), fixed_binary(own), fixed_binary(other), pa.array(likeness(own, other)), pa.array(likeness(own, next_digests))]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
TYPES = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def edit_study(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last quarter is the next document's beginning.

    The next document is the one of the next id (nulls last; rows of one id in the order of a hash
    of their text), and the first one's after the last. Rows are range-partitioned by id and
    sorted, so a document's successor is the next row of its partition; only each partition's first and
    last rows are joined to the neighbouring partition's. A null text counts as empty; repeated rows
    follow each other; the only row of a table follows itself; an empty table gives no rows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    docs = id_and_text(docs)
    kind = dict(docs.dtypes)["doc_id"]
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.monotonically_increasing_id()]
    ordered = docs.repartitionByRange(*order).sortWithinPartitions(F.col("doc_id").asc_nulls_last(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()  # type: ignore[union-attr]

        def edge(which: int, row: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([which], pa.int32()), pa.array([partition], pa.int64()), row.column("text"), row.column("doc_id"), *(pa.nulls(1, t) for t in kinds)], ["which", "partition", "text", *NAMES])

        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
        last = None
        for batch in batches:
            for part in chunks(batch):
                if last is None:
                    yield edge(1, part.slice(0, 1))
                else:
                    part = pa.Table.from_batches([last, part]).combine_chunks().to_batches()[0]
                last = part.slice(len(part) - 1)
                texts = part.column("text").to_pylist()
                if len(texts) > 1:
                    rows = _rows(part.column("doc_id").slice(0, len(texts) - 1), texts[:-1], texts[1:], digests(last.column("text")))
                    n = len(texts) - 1
                    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, partition)), pa.nulls(n, pa.string()), *rows], ["which", "partition", "text", *NAMES])
        if last is not None:
            yield edge(2, last)

    made = ordered.mapInArrow(run, f"which int, partition long, text string, doc_id {kind}, {TYPES}").checkpoint()
    first = made.where("which = 1").select("partition", F.col("text").alias("next_text"))
    lead = F.lead("partition").over(Window.orderBy("partition"))  # one row per partition
    follows = first.select("partition", F.coalesce(lead, F.min("partition").over(Window.partitionBy())).alias("next_partition"))
    pairs = made.where("which = 2").select("partition", "doc_id", "text").join(follows, "partition").join(first.withColumnRenamed("partition", "next_partition"), "next_partition").select("doc_id", "text", "next_text")

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                yield pa.RecordBatch.from_arrays(_rows(part.column("doc_id"), part.column("text").to_pylist(), part.column("next_text").to_pylist()), NAMES)

    out = made.where("which = 0").select(*NAMES).unionByName(pairs.mapInArrow(ends, f"doc_id {kind}, {TYPES}"))
    return out.select("doc_id", "n_chars", *[F.lower(F.hex(c)).alias(c) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")], "near_edited", "near_next")
