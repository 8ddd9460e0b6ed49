"""Near-duplicate documents by ProbMinHash, banding and verification.

A text is a set of five-word shingles of equal weight. Each shingle is a Poisson process whose
arrivals, at its weight's rate, fall on random registers; a register keeps the shingle that
arrives first. A shingle stops once it is later than every register of its text. Registers of
two texts agree with their probability Jaccard, which at equal weights is the Jaccard of the
sets: the measure that links are verified by. (Weights by count would let a repeated
section push the agreement of linked texts far below it.)

Equal texts are one node. Nodes that share a band are compared with the band bucket's
most central node, so a bucket gives as many pairs as it has nodes; texts of the pairs are
compared exactly. Where a bucket still holds nodes of different components, those are
compared further, with other central nodes and then with each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramflow.llm.common import chunks, id_and_text, mix64, powers, ragged, span_hashes, text_bytes, word_spans
from tramflow.llm.fingerprints import fixed_binary
from tramflow.llm.components import components
from tramflow.session import ensure_checkpoint_dir

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 24, 4
#: Comparisons with a bucket's central nodes before its remaining pairs are listed.
STAR_ROUNDS = 1
#: Nodes in a block of such a listing, and the agreeing registers that its pairs need.
BLOCK, BLOCK_CHARS, AGREE = 4096, 4 << 20, 58
REGISTERS = BANDS * ROWS
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text: row, 64-bit hash and count, ordered by row and hash.

    A text of one to four words is one shingle; a text without words has none.
    """
    data, offsets = text_bytes(column)
    starts, ends, row = word_spans(data, offsets)
    words = span_hashes(data, starts, ends, seed=5)
    per_row = np.bincount(row, minlength=len(column)) if len(row) else np.zeros(len(column), np.int64)
    first = np.cumsum(per_row) - per_row
    place = np.arange(len(row)) - first[row]
    opens = (place + SHINGLE_WORDS <= per_row[row]) | ((place == 0) & (per_row[row] < SHINGLE_WORDS))
    at = np.flatnonzero(opens)
    padded = np.concatenate([words, np.zeros(SHINGLE_WORDS, np.uint64)])
    out, factors = np.zeros(len(at), np.uint64), powers(SHINGLE_WORDS + 1)[1:]
    last = (first + per_row)[row[at]]
    for k in range(SHINGLE_WORDS):
        out += np.where(at + k < last, padded[at + k] * factors[k], np.uint64(0))
    out, row = mix64(out), row[at]
    order = np.lexsort((out, row))
    out, row = out[order], row[order]
    new = np.append(True, (out[1:] != out[:-1]) | (row[1:] != row[:-1]))[: len(out)]
    where = np.flatnonzero(new)
    return row[where], out[where], np.diff(np.append(where, len(out)))


def registers(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """First shingle of each of ``m`` registers for each of ``n`` texts (0 where a text has none)."""
    first, kept = np.full(n * m, np.inf), np.zeros(n * m, np.uint64)
    time = np.zeros(len(element))
    j = 0
    with np.errstate(over="ignore"):
        while len(element):
            j += 1
            drawn = mix64(element + GOLDEN * np.uint64(j))
            time = time - np.log((drawn >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / weight
            cell = row * m + (mix64(drawn ^ GOLDEN) % np.uint64(m)).astype(np.int64)
            np.minimum.at(first, cell, time)
            won = first[cell] == time
            kept[cell[won]] = element[won]
            on = time < first.reshape(n, m).max(axis=1)[row]
            row, element, weight, time = row[on], element[on], weight[on], time[on]
    return kept.reshape(n, m)


def bands(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A 64-bit key per band of each text, a byte per register, and the texts' shingle counts."""
    row, element, _ = shingles(column)
    kept = registers(row, element, np.ones(len(element)), len(column))
    banded = kept.reshape(len(column), BANDS, ROWS)
    keys = np.zeros((len(column), BANDS), np.uint64)
    for k in range(ROWS):
        keys = mix64(keys * GOLDEN + banded[:, :, k])
    return keys.view(np.int64), (kept & np.uint64(255)).astype(np.uint8), np.bincount(row, minlength=len(column))


def jaccard(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Exact Jaccard of the shingle sets of each pair of texts (0 where neither has words)."""
    n = len(left)
    a_row, a, _ = shingles(left)
    b_row, b, _ = shingles(right)
    row, element = np.concatenate([a_row, b_row]), np.concatenate([a, b])
    order = np.lexsort((element, row))
    row, element = row[order], element[order]
    both = np.bincount(row[1:][(row[1:] == row[:-1]) & (element[1:] == element[:-1])], minlength=n)
    return both / np.maximum(np.bincount(row, minlength=n) - both, 1)


def node_of(text: Column) -> Column:
    """64 bits of the text's MD5: equal texts are one node."""
    return F.conv(F.substring(F.md5(text), 1, 16), 16, -10).cast("long")


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, node, bands, marks`` of every row; a text without words has no bands. ``marks`` has a byte per register."""
    docs = id_and_text(docs).withColumn("node", node_of(F.col("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch):
                keys, marks, count = bands(part.column("text"))
                ends = np.append(0, np.cumsum(np.where(count > 0, BANDS, 0))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("node"), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[count > 0].ravel())), fixed_binary(marks)], ["doc_id", "node", "bands", "marks"])

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, node long, bands array<long>, marks binary")


def node_texts(nodes: DataFrame, docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """``node, text`` for the nodes given. ``chosen`` names one document for each node, so copies are not moved."""
    needed = nodes.join(chosen, "node")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("node", node_of(F.col("text")))
    same = F.col("t.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("t.node") == F.col("n.node"))
    return texts.alias("t").join(needed.alias("n"), same, "left_semi").dropDuplicates(["node"]).select("node", "text").checkpoint()


def verified(pairs: DataFrame, docs: DataFrame, chosen: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose texts reach the similarity; only documents of some pair are read on."""
    texts = node_texts(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for half in chunks(batch, "left_text"):
                for part in chunks(half, "right_text"):
                    near = jaccard(part.column("left_text"), part.column("right_text")) >= similarity
                    yield part.select(["a", "b"]).filter(pa.array(near))

    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("left_text")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("right_text")), "b")
    return both.select("a", "b", "left_text", "right_text").mapInArrow(run, "a long, b long").checkpoint()


def block_links(opened: DataFrame, signed: DataFrame, docs: DataFrame, chosen: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` among all pairs of one bucket and different components.

    A bucket's nodes are dealt into blocks of about ``BLOCK`` nodes or ``BLOCK_CHARS`` of text, and each pair of
    blocks is one row, compared in numpy: in the first band two nodes share, and exactly where their
    registers agree as those of linked texts do. At a similarity of 0.8 fewer than ``AGREE`` of 96 agree for
    3.0 pairs in a million, and no band is shared by 3.2, so this keeps a link as surely as the bands themselves.
    """
    nodes = opened.select("node").distinct()
    heavy = signed.join(nodes, "node", "left_semi").select("node", "marks").dropDuplicates(["node"]).join(node_texts(nodes, docs, chosen), "node").checkpoint()
    rows = opened.select("band", "key", "node", "label").join(heavy.select("node", F.char_length("text").alias("chars")), "node")
    most = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("chars") / BLOCK_CHARS)
    count = rows.groupBy("band", "key").agg(F.ceil(most).alias("blocks"))
    dealt = rows.join(count, ["band", "key"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))).join(heavy, "node")
    fields = ("node", "label", "marks", "text")
    blocks = dealt.groupBy("band", "key", "block", "blocks").agg(F.collect_list(F.struct(*fields)).alias("l")).checkpoint()
    own = blocks.select("band", F.col("l").alias("l"), F.col("l").alias("r"))
    many = blocks.where("blocks > 1")
    other = many.alias("a").join(many.alias("b"), ["band", "key"]).where("a.block < b.block").select("band", F.col("a.l").alias("l"), F.col("b.l").alias("r"))
    both = own.unionByName(other)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                sides = [{f: batch.column(side)[r].values.field(f) for f in fields} for side in "lr"]
                found = compare_blocks(*sides, batch.column("band")[r].as_py(), similarity)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found.min(axis=1)), pa.array(found.max(axis=1))], ["a", "b"])

    return both.mapInArrow(run, "a long, b long").distinct().checkpoint()


def compare_blocks(left: dict[str, pa.Array], right: dict[str, pa.Array], band: int, similarity: float) -> np.ndarray:
    """Linked pairs of nodes, one of each block, of different components, that agree on no band before this one.

    One node of such a pair is not of the most common component, so only those are compared with all others.
    """
    labels = np.concatenate([left["label"].to_numpy(), right["label"].to_numpy()])
    value, count = np.unique(labels, return_counts=True)
    common = value[count.argmax()]
    found = [_odd_nodes(left, right, common, band, similarity)]
    if not left["node"].equals(right["node"]):
        found.append(_odd_nodes(right, left, common, band, similarity))
    return np.concatenate(found)


def _odd_nodes(left: dict[str, pa.Array], right: dict[str, pa.Array], common: int, band: int, similarity: float) -> np.ndarray:
    """Linked pairs of the left nodes outside the ``common`` component with right nodes."""
    odd = np.flatnonzero(left["label"].to_numpy() != common)
    if not len(odd):
        return np.zeros((0, 2), np.int64)
    left = {f: left[f].take(pa.array(odd)) for f in left}
    a, la, b, lb = (side[c].to_numpy() for side in (left, right) for c in ("node", "label"))
    x, y = (np.frombuffer(b"".join(side["marks"].to_pylist()), np.uint8).reshape(-1, REGISTERS) for side in (left, right))
    of, element, _ = shingles(right["text"])
    order = np.argsort(element, kind="stable")
    element, of = element[order], of[order]
    size = np.bincount(of, minlength=len(b))
    own, wanted, _ = shingles(left["text"])
    edge = np.searchsorted(own, np.arange(len(a) + 1))
    out = []
    for k in range(len(a)):
        agree = y == x[k]
        near = np.flatnonzero((agree.sum(axis=1) >= AGREE) & (lb != la[k]))
        if band and len(near):
            near = near[~agree[near, : band * ROWS].reshape(len(near), band, ROWS).all(axis=2).any(axis=1)]
        if len(near):
            e = wanted[edge[k] : edge[k + 1]]
            low, high = np.searchsorted(element, e, side="left"), np.searchsorted(element, e, side="right")
            both = np.bincount(of[ragged(low, high - low)], minlength=len(b))[near]
            out += [(a[k], other) for other in b[near[both >= similarity * (size[near] + len(e) - both)]]]
    return np.array(out, np.int64).reshape(-1, 2)


def near_links(docs: DataFrame, signed: DataFrame, similarity: float = SIMILARITY, rounds: int = STAR_ROUNDS) -> DataFrame:
    """Links between nodes such that their components are those of all verified candidate pairs.

    A bucket's nodes are compared with its most central node first: the one whose buckets hold most
    nodes, since a text near the middle of a group keeps most of the registers its group has. Buckets
    whose nodes are of one component by then are done. In the others the next most central nodes
    follow, and at last the pairs of different components, block by block.
    """
    chosen = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    rows = signed.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = rows.groupBy("band", "key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    shared = rows.join(buckets.select("band", "key"), ["band", "key"], "left_semi").distinct().checkpoint()
    sizes = shared.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size"))
    weight = shared.join(sizes, ["band", "key"]).groupBy("node").agg(F.sum("size").alias("weight"))
    shared = shared.join(weight, "node").checkpoint()
    opened, links, used = shared.withColumn("label", F.col("node")), None, None
    for step in range(rounds + 1):
        if step < rounds:  # a bucket's next central node
            free = opened if used is None else opened.join(used, ["band", "key", "node"], "left_anti")
            rep = free.groupBy("band", "key").agg(F.max(F.struct("weight", "node", "label")).alias("r")).select("band", "key", F.col("r.node").alias("rep"), F.col("r.label").alias("rep_label"))
            pairs = opened.join(rep, ["band", "key"]).where("label <> rep_label").select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b"))
            now = rep.select("band", "key", F.col("rep").alias("node"))
            used = (now if used is None else used.unionByName(now)).checkpoint()
        else:
            return links.unionByName(block_links(opened, signed, docs, chosen, similarity))
        found = verified(pairs.distinct().checkpoint(), docs, chosen, similarity)
        links = found if links is None else links.unionByName(found).checkpoint()
        label = components(links)
        opened = shared.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = opened.groupBy("band", "key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
        opened = opened.join(mixed.select("band", "key"), ["band", "key"], "left_semi").checkpoint()
        if not opened.take(1):
            break
    return links


def node_labels(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, node, label`` of every row; the rows of one label are a class."""
    ensure_checkpoint_dir(docs.sparkSession)
    signed = signatures(docs).checkpoint()
    label = components(near_links(docs, signed, similarity))
    return signed.select("doc_id", "node").join(label, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label"))


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, class_size, kept`` for every row of ``docs``.

    A class is a component of texts that are equal or linked: whose sets of five-word shingles have a
    Jaccard of ``similarity`` or more. ``class_id`` is its smallest id, and ``kept`` marks that row. Texts
    without words (null, empty, blank) are linked to equal texts only. A null id is larger than any
    other: a class has no id only if none of its rows has one. Repeated rows are counted one by one.
    """
    rows = node_labels(docs, similarity)
    classes = rows.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(classes, "label").select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that stay when each class keeps one text: its smallest id's, and of that id's the smallest node.

    Null ids and repeated ids name no single text, so rows stay by id and text; a repeated row stays once.
    """
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("first")
    kept = node_labels(docs, similarity).groupBy("label").agg(first).select(F.col("first.doc_id").alias("_kept"), F.col("first.node").alias("_node"))
    node = node_of(F.coalesce("text", F.lit("")))
    same = F.col("doc_id").eqNullSafe(F.col("_kept")) & (F.col("_text") == F.col("_node"))
    return docs.withColumn("_text", node).join(kept, same, "left_semi").dropDuplicates(["doc_id", "_text"]).drop("_text")
