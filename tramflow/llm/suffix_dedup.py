"""Suffix-array dedup: column-wise construction over a collection of anchored segments.

Which bytes lie in a 400-byte string that also starts elsewhere is decided by common prefixes
of neighbouring suffixes. To spread that over tasks, every text is cut around anchors: the
64-byte windows whose hash is smallest among the windows of some 400-byte string. Equal
400-byte strings have their anchor at the same offset, so all their occurrences meet in the anchor's
group, as segments that hold every 400-byte string around the anchor, aligned at it.

A task builds the order of its collection's suffixes column by column from the right: each
round inserts one symbol of every segment, reorders the suffixes stably by it (the
symbols in suffix order are that round's column of the Burrows-Wheeler transform) and
updates the common prefixes of neighbours by the minimum over the suffixes between them. Rounds read the
segments' sorted shuffle files once; only the last column, its order and prefixes are kept.

A group of more than ``HOT`` segments, which would be one task's work, is decided by
counting the hashes of its 400-byte strings instead, partly before the shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tramflow.llm.common import byte_table, chunks, mix64, text_bytes
from tramflow.llm.probminhash import node_of
from tramflow.session import ensure_checkpoint_dir

#: Bytes of a repeated string, where the caller names no other length. The bytes beside an anchor that matter are
#: ``length - ANCHOR`` on either side; one more is the number of windows in a string, one of which is its anchor.
LENGTH = 400
ANCHOR = 64
HOT = 50_000
#: Segments that one collection holds at most, unless one group has more.
SEGMENTS = 16_384
#: Bytes scanned for anchors at once.
SCAN_BYTES = 1 << 20


def sliding(op: np.ufunc, x: np.ndarray, width: int) -> np.ndarray:
    """``op`` over each run of ``width`` values, by prefixes and suffixes of blocks."""
    n = len(x)
    size = -(-n // width) * width
    padded = np.concatenate([x, np.full(size - n, x[-1])]).reshape(-1, width)
    ahead = op.accumulate(padded, axis=1).ravel()
    behind = op.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[: n - width + 1], ahead[width - 1 : n])


def window_hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` bytes, by doubling."""
    out, have = byte_table(8)[data], 1
    result, done = None, 0
    with np.errstate(over="ignore"):
        while done < width:
            if width & have:  # the next part of the run, after the ``done`` bytes before it
                part = out[done:]
                result = out.copy() if result is None else mix64(result[: len(part)] * np.uint64(0x9E3779B97F4A7C15) + part[: len(result)])
                done += have
            if done < width:
                out = mix64(out[:-have] * np.uint64(0xD6E8FEB86659FD93) + out[have:])
                have *= 2
    return result[: len(data) - width + 1]


def anchors(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a text's anchors: windows that are smallest in some string of ``length`` bytes, ties included."""
    windows = length - ANCHOR + 1
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, hashes = [], []
    for at in range(0, len(data) - ANCHOR + 1, SCAN_BYTES):  # anchors lie up to the last window
        low = max(at - length, 0)
        part = window_hashes(data[low : at + SCAN_BYTES + 2 * length], ANCHOR)
        least = sliding(np.minimum, part, windows)
        edge = np.zeros(windows - 1, np.uint64)
        chosen = np.flatnonzero(part == sliding(np.maximum, np.concatenate([edge, least, edge]), windows))
        chosen = chosen[(chosen + low >= at) & (chosen + low < at + SCAN_BYTES)]
        places.append(chosen + low)
        hashes.append(part[chosen])
    place, first = np.unique(np.concatenate(places), return_index=True)
    return place, np.concatenate(hashes)[first]


def periodic(data: np.ndarray, place: np.ndarray, hashed: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which anchors to keep, and the long regions of one short period that the others lie in.

    Equal anchors at one distance of ``ANCHOR`` bytes or less make a region of that period. In a region of
    ``length`` bytes and two periods every string of that length starts again a period on or before, so it repeats as
    a whole. A string that leaves the region has its first or last anchor, in every text alike. One
    inside it may also be all that a shorter run in another text has, in any phase: the strings that start in
    the region's first period are all phases, and each has its first anchor among the region's first two.
    """
    keep, regions = np.ones(len(place), bool), []
    if len(place) < 3:
        return keep, regions
    step = np.diff(place)
    step[(hashed[1:] != hashed[:-1]) | (step > ANCHOR)] = 0
    edges = np.flatnonzero(np.append(True, step[1:] != step[:-1]))
    for a, b in zip(edges.tolist(), np.append(edges[1:], len(step)).tolist(), strict=True):
        p = int(step[a])
        if p and int(place[b] - place[a]) + ANCHOR + 2 * p >= length:
            low, high = int(place[a]), int(place[b]) + ANCHOR
            while low and data[low - 1] == data[low - 1 + p]:
                low -= 1
            while high < len(data) and data[high] == data[high - p]:
                high += 1
            if high - low >= length + 2 * p:
                keep[a + 2 : b] = False
                regions.append((low, high))
    return keep, regions


def anchor_rows(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, node, places, hashes, regions`` of every row of ``doc_id, node, text`` that has an anchor.

    ``regions`` holds the first byte and the one after the last of each periodic region, one after the other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                data, ends = text_bytes(part.column("text"))
                found = [anchors(data[a:b], length) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                edges = pa.array(np.append(0, np.cumsum([len(p) for p, _ in found])).astype(np.int32))
                has = pa.array([len(p) > 0 for p, _ in found], pa.bool_())
                spans = [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
                marked = [(p, h, *periodic(d, p, h, length)) for d, (p, h) in zip(spans, found, strict=True) if len(p)]
                found = [(p[keep], h[keep]) for p, h, keep, _ in marked]
                regions = pa.array([[x for r in found_regions for x in r] for *_, found_regions in marked], pa.list_(pa.int32()))
                edges = pa.array(np.append(0, np.cumsum([len(p) for p, _ in found])).astype(np.int32))
                places = np.concatenate([np.zeros(0, np.int64), *(p for p, _ in found)]).astype(np.int32)
                hashes = np.concatenate([np.zeros(0, np.uint64), *(h for _, h in found)]).view(np.int64)
                lists = [pa.ListArray.from_arrays(edges, pa.array(v)) for v in (places, hashes)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").filter(has), part.column("node").filter(has), *lists, regions], ["doc_id", "node", "places", "hashes", "regions"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(run, f"doc_id {kind}, node long, places array<int>, hashes array<long>, regions array<int>")


def repeated_starts(cells: np.ndarray, inside: np.ndarray, group: np.ndarray, weight: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of a string of ``length`` bytes that repeats, for each segment (first > last: none).

    ``cells`` is segments by columns, ``inside`` marks the bytes that exist, ``group`` numbers the groups in
    ascending order. A segment of weight 2 or more repeats as a whole.
    """
    n, side = len(cells), length - ANCHOR
    width = length + side
    low, high = np.full(n, width, np.int64), np.full(n, -1, np.int64)
    begin, end = inside.argmax(axis=1), width - inside[:, ::-1].argmax(axis=1)
    many = (weight > 1) & (end - begin >= length)
    low[many], high[many] = begin[many], np.minimum(end[many] - length, side)
    size = np.bincount(group)
    rows = np.flatnonzero(size[group] > 1)
    if not len(rows):
        return low, high
    cells, inside, own = np.ascontiguousarray(cells[rows].T), np.ascontiguousarray(inside[rows].T), group[rows]
    own = np.unique(own, return_inverse=True)[1]
    own = own.astype(np.uint16) if own[-1] < 65536 else own
    order, prefix = np.arange(len(rows)), np.zeros(len(rows) + 1, np.int32)  # prefix[k]: of suffixes k-1 and k
    for column in range(width - 1, -1, -1):
        symbol = cells[column][order]  # this column of the transform
        by_symbol = np.argsort(symbol, kind="stable")
        rank = by_symbol[np.argsort(own[order][by_symbol], kind="stable")]
        before, after = rank[:-1], rank[1:]
        moved = order[rank]
        same = (own[moved[1:]] == own[moved[:-1]]) & (symbol[before] == symbol[after]) & inside[column][moved[1:]] & inside[column][moved[:-1]]
        near = prefix[after]
        far = np.flatnonzero(same & (after - before > 1))
        if len(far):
            between = np.stack([before[far] + 1, after[far] + 1], axis=1).ravel()
            near[far] = np.minimum.reduceat(prefix, between)[::2]
        prefix[0] = 0
        prefix[1:-1] = np.where(same, near + 1, 0)
        order = moved
        if column <= side:
            hit = np.flatnonzero(prefix[1:-1] >= length)
            if len(hit):
                found = rows[np.concatenate([order[hit], order[hit + 1]])]
                low[found] = np.minimum(low[found], column)
                high[found] = np.maximum(high[found], column)
    return low, high


def segments(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """``hash, node, places, weight, lead, segment``: the bytes around each repeated anchor of ``node, text, spots``.

    A text that repeats itself has equal segments at many places; they are one row, weighted by their number.
    """
    side = length - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                data, ends = text_bytes(part.column("text"))
                raw = data.tobytes()
                for r, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                    spots = part.column("spots")[r].values
                    found: dict[tuple, list[int]] = {}
                    for h, place in zip(spots.field("hash").to_pylist(), spots.field("place").to_pylist(), strict=True):
                        low = max(a + place - side, a)
                        found.setdefault((h, a + place - low, raw[low : min(a + place + ANCHOR + side, b)]), []).append(place)
                    if found:
                        copies, node = spots.field("weight")[0].as_py(), part.column("node")[r].as_py()
                        out.extend((h, node, sorted(places), copies * len(places), lead, cut) for (h, lead, cut), places in found.items())
                    if len(out) >= SEGMENTS:
                        yield batch_of(out)
                        out.clear()
        if out:
            yield batch_of(out)

    out: list[tuple] = []
    names = ("hash", "node", "places", "weight", "lead", "segment")
    kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.int64(), pa.int32(), pa.binary())

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))

    return rows.mapInArrow(run, "hash long, node long, places array<int>, weight long, lead int, segment binary")


def _matrix(lead: np.ndarray, segment: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments aligned at their anchors, and which cells hold a byte."""
    edges = np.frombuffer(segment.buffers()[1], np.int32)[segment.offset : segment.offset + len(segment) + 1].astype(np.int64)
    data = np.frombuffer(segment.buffers()[2], np.uint8)[edges[0] : edges[-1]]
    side = length - ANCHOR
    column = np.arange(length + side)
    start, size = (side - lead)[:, None], np.diff(edges)[:, None]
    inside = (column >= start) & (column < start + size)
    cells = np.zeros((len(lead), length + side), np.uint8)
    cells[inside] = data
    return cells, inside


def decide(table: pa.Table, length: int = LENGTH) -> pa.RecordBatch:
    """``node, first, last`` byte ranges that repeat, from whole groups of segments ordered by hash."""
    # Equal segments of a group are one string of the collection, with their weights added.
    key = list(zip(table.column("hash").to_pylist(), table.column("lead").to_pylist(), table.column("segment").to_pylist(), strict=True))
    number: dict = {}
    code = np.array([number.setdefault(k, len(number)) for k in key])
    first = np.unique(code, return_index=True)[1]
    weight = np.bincount(code, weights=np.asarray(table.column("weight"))).astype(np.int64)
    distinct = table.take(pa.array(first)).combine_chunks()
    cells, inside = _matrix(np.asarray(distinct.column("lead"), np.int64), distinct.column("segment").combine_chunks() if isinstance(distinct.column("segment"), pa.ChunkedArray) else distinct.column("segment"), length)
    group = np.unique(np.asarray(distinct.column("hash")), return_inverse=True)[1]
    low, high = repeated_starts(cells, inside, group, weight, length)
    places = table.column("places").combine_chunks()
    row = np.repeat(np.arange(len(table)), np.asarray(pa.compute.list_value_length(places)))
    place = np.asarray(places.flatten(), np.int64) - (length - ANCHOR)
    first, last = place + low[code[row]], place + high[code[row]] + length
    # Places of a row ascend: a range that meets the one before is joined to it.
    hit = np.flatnonzero(low[code[row]] <= high[code[row]])
    row, first, last = row[hit], first[hit], last[hit]
    new = np.append(True, (row[1:] != row[:-1]) | (first[1:] > last[:-1]))[: len(row)]
    end = np.append(new[1:], True)[: len(row)]
    return pa.RecordBatch.from_arrays([table.column("node").combine_chunks().take(pa.array(row[new])), pa.array(first[new]), pa.array(last[end])], ["node", "first", "last"])


def column_ranges(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """``node, first, last`` of segments dealt by their anchor; a group is never split between collections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows < SEGMENTS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            hashes = np.asarray(table.column("hash"))
            edges = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            done = 0
            while len(edges) and rows - done > SEGMENTS:
                whole = edges[(edges > done) & (edges <= done + SEGMENTS)]
                whole = whole[-1:] if len(whole) else edges[edges > done][:1]
                if not len(whole):
                    break
                yield decide(table.slice(done, int(whole[0]) - done), length)
                done = int(whole[0])
            held, rows = table.slice(done).to_batches(), rows - done
        if rows:
            table = pa.Table.from_batches(held).combine_chunks()
            hashes = np.asarray(table.column("hash"))
            edges = np.append(np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1])), rows)
            done = 0
            while done < rows:
                whole = edges[(edges > done) & (edges <= done + SEGMENTS)]
                stop = int(whole[-1]) if len(whole) else int(edges[edges > done][0])
                yield decide(table.slice(done, stop - done), length)
                done = stop

    return cut.repartition("hash").sortWithinPartitions("hash").mapInArrow(run, "node long, first long, last long")


def counted_ranges(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same for groups too large for one task: by counting their strings of ``length`` bytes, combined before the shuffle."""
    side = length - ANCHOR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "segment"):
                segment = part.column("segment").to_pylist()
                for r, (h, node, places, weight, lead) in enumerate(zip(*(part.column(c).to_pylist() for c in ("hash", "node", "places", "weight", "lead")), strict=True)):
                    starts = np.arange(side - lead, side - lead + len(segment[r]) - length + 1)
                    keys = [hashlib.md5(segment[r][s - side + lead : s - side + lead + length]).digest() for s in starts]
                    n = len(starts)
                    yield pa.RecordBatch.from_arrays([pa.array([h] * n, pa.int64()), pa.array(starts.astype(np.int32)), pa.array(keys, pa.binary()), pa.array([node] * n, pa.int64()), pa.array([places] * n, pa.list_(pa.int32())), pa.array([weight] * n, pa.int64())], ["hash", "start", "key", "node", "places", "weight"])

    strings = cut.mapInArrow(run, "hash long, start int, key binary, node long, places array<int>, weight long")
    often = strings.groupBy("hash", "start", "key").agg(F.sum("weight").alias("n")).where("n > 1")
    found = strings.join(often, ["hash", "start", "key"]).select("node", "start", F.explode("places").alias("place"))
    return found.select("node", (F.col("place") - side + F.col("start")).cast("long").alias("first")).select("node", "first", (F.col("first") + length).alias("last"))


def repeated_ranges(docs: DataFrame, hot: int = HOT, *, length: int = LENGTH) -> DataFrame:
    """``node, ranges`` for every text of ``doc_id, text, node`` with a byte to remove; ranges may overlap.

    A byte goes if a string of ``length`` bytes (two anchors at least) that covers it also starts elsewhere.
    Copies of a text are scanned but give one set of anchors, whose weight is their number.
    """
    if length < 2 * ANCHOR:  # a string's windows must hold every phase of the longest period
        raise ValueError(f"length must be {2 * ANCHOR} bytes or more")
    scanned = anchor_rows(docs, length).checkpoint()
    chosen = scanned.groupBy("node").agg(F.min("doc_id").alias("chosen"), F.count(F.lit(1)).alias("weight"))
    first = scanned.join(chosen, "node").where(F.col("doc_id").eqNullSafe(F.col("chosen")))
    once = first.select("node", "weight", F.explode(F.arrays_zip("places", "hashes")).alias("s")).select(F.col("s.hashes").alias("hash"), "node", F.col("s.places").alias("place"), "weight")
    often = once.groupBy("hash").agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("size")).where("n > 1").select("hash", (F.col("size") > hot).alias("hot"))
    spots = once.join(often, "hash").groupBy("node").agg(F.collect_set(F.struct("place", "hash", "weight", "hot")).alias("spots"))
    spots = spots.join(chosen.select("node", "chosen"), "node").checkpoint()
    texts = docs.join(spots, "node").where(F.col("doc_id").eqNullSafe(F.col("chosen")))
    ranges = column_ranges(segments(texts.select("node", "text", F.filter("spots", lambda s: ~s["hot"]).alias("spots")), length), length)
    if spots.where(F.exists("spots", lambda s: s["hot"])).take(1):
        ranges = ranges.unionByName(counted_ranges(segments(texts.select("node", "text", F.filter("spots", lambda s: s["hot"]).alias("spots")), length), length))
    at = F.explode(F.sequence(F.lit(1), F.size("regions"), F.lit(2)))
    periods = first.where(F.size("regions") > 0).select("node", "regions", at.alias("k")).select("node", *[F.element_at("regions", F.col("k") + j).cast("long").alias(c) for j, c in enumerate(("first", "last"))])
    ranges = ranges.unionByName(periods)
    return ranges.groupBy("node").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))


def kept_mask(size: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    steps = np.zeros(size + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last, -1)
    return np.cumsum(steps[:-1]) == 0


def kept_bytes(part: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and the mask of kept ones of each ``text``, by its ``ranges`` (null: none)."""
    data, ends = text_bytes(part.column("text"))
    for r, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        spans = part.column("ranges")[r].values
        keep = np.ones(b - a, bool)
        if spans is not None:
            keep = kept_mask(b - a, np.asarray(spans.field("first"), np.int64), np.asarray(spans.field("last"), np.int64))
        yield data[a:b], keep


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, text`` for every row of ``docs``.

    A byte goes if a string of ``length`` bytes that covers it also starts elsewhere, in any document. ``kept_sha256``
    is the hash of the bytes that stay, and ``text`` is what they spell: where a cut falls inside a character, the rest of
    that character is not in it. A null text counts as empty; texts shorter than ``length`` lose nothing. A repeated row
    is a document of its own, so a text that long that has a copy goes whole. Other columns, clashing or not, are
    left out; an empty table gives no rows. Texts are compared as 64 bits of their MD5 first.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    docs = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn("node", node_of(F.col("text")))
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                out = []
                for raw, keep in kept_bytes(part):
                    edge = ~keep & np.append(True, keep[:-1])[: len(keep)]
                    kept = raw[keep].tobytes()
                    out.append((len(raw), int((~keep).sum()), int(edge.sum()), hashlib.sha256(kept).digest(), kept.decode("utf-8", errors="ignore")))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([o[k] for o in out], t) for k, t in enumerate(kinds))], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    # The texts' exchange by node is the one that the segments were cut from.
    both = docs.join(repeated_ranges(docs, length=length), "node", "left").select("doc_id", "text", "ranges")
    return both.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 binary, text string").withColumn("kept_sha256", F.lower(F.hex("kept_sha256")))


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows of ``docs`` without the bytes that a repeated string of ``length`` bytes covers; ``n_chars`` is counted anew.

    Where a cut falls inside a character, the rest of that character goes too. Columns of any names come
    back; a null text counts as empty; an empty table gives no rows.
    """
    ensure_checkpoint_dir(docs.sparkSession)
    order = docs.columns
    inner = [f"c{at}" for at in range(len(order))]  # no name of the caller's meets one of ours
    doc_id, text = (inner[order.index(c)] for c in ("doc_id", "text"))
    rows = docs.toDF(*inner).withColumn(text, F.coalesce(text, F.lit(""))).withColumnRenamed(text, "text").withColumn("node", node_of(F.col("text")))
    ranges = repeated_ranges(rows.select(F.col(doc_id).alias("doc_id"), "text", "node"), length=length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                texts = pa.array([raw[keep].tobytes().decode("utf-8", errors="ignore") for raw, keep in kept_bytes(part)], pa.string())
                yield pa.RecordBatch.from_arrays([texts if c == text else part.column(c) for c in inner], inner)

    given = [c if c != text else "text" for c in inner]
    schema = StructType([StructField(c, field.dataType) for c, field in zip(inner, docs.schema, strict=True)])
    out = rows.join(ranges, "node", "left").select(*given, "ranges").mapInArrow(run, schema).toDF(*order)
    return out.withColumn("n_chars", F.char_length("text").cast("long")).select(*order)
