"""Token ids as files: each document compressed alone against one shared zstandard dictionary.

A store is a folder with the dictionary, shard files and an index. A shard starts with a header (mark,
SHA-256 of the dictionary, bytes per id) and goes on with one zstandard frame per document. The
index is a Parquet table with the file, offset and size of every document's frame, so that
one short document is read and decompressed without its neighbours. It is sorted by id, like the shards.

A task writes its shard under a name of its own and hands the name on in its index rows. The index is
committed by Spark, so a shard whose task was lost is in no index, and a task that is run
again writes another file.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramflow.llm.common import byte_letters, chunks, id_and_text
from tramflow.llm.memo import Memo

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
MARK = b"idz1"
HEADER_BYTES = len(MARK) + 32 + 1
LEVEL = 3
DICTIONARY_BYTES = 64 << 10
#: The dictionary is trained on about this many documents, twice as many at most, of this many code points at most. It bears on sizes alone.
SAMPLE_ROWS = 2_000
SAMPLE_CHARS = 8_000
READ_BYTES = 4 << 20
#: The vocabulary's normal form and its pattern for pieces (fixed values), and what it comes to for lowered words of printable Latin-1 characters.
NORMAL_FORM = ["NFC", "Replace", "Lowercase"]
RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN = re.compile("[\\t-\\r -~¡-ÿ]*")
LETTERS, NUMBERS = "a-zªµºß-öø-ÿ", "0-9²³¹¼-¾"
OTHER, LETTER, NUMBER, SPACE = range(4)
KINDS = np.array([next((k for k, r in ((LETTER, LETTERS), (NUMBER, NUMBERS), (SPACE, "\\t-\\r ")) if re.match(f"[{r}]", chr(b))), OTHER) for b in range(256)], np.uint8)


class WordEncoder:
    """Ids of whole texts, as bytes.

    A text of ASCII white space and printable Latin-1 characters is lowered and split by the vocabulary's own pattern, and needs
    no normal form. The library's merges take each distinct piece once, by the letters that stand for its
    bytes. Any other text, and one with a special token, goes to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        rules = json.loads(self.tokenizer.to_str())
        self.special = re.compile("|".join(re.escape(t["content"]) for t in rules["added_tokens"]) or "(?!)")
        steps = [(rules[k] or {}).get(f, [{}]) for k, f in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        known = [n.get("type") for n in steps[0]] == NORMAL_FORM and steps[1][0].get("pattern") == {"Regex": RULE}
        self.plain = PLAIN if known else re.compile("(?!)")
        self.merges = Tokenizer(self.tokenizer.model)  # type: ignore[attr-defined]
        self.merges.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for entry, i in vocabulary.items() if entry.endswith(rules["model"]["end_of_word_suffix"] or "\0")]] = True
        self.letters = {byte: letter for letter, byte in byte_letters().items() if byte != 32}
        self.memo = Memo(self._merged)

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [bool(self.plain.fullmatch(t)) and not self.special.search(t) for t in texts]
        lowered = [t.lower().encode("latin-1") for t, ok in zip(texts, plain, strict=True) if ok]
        offsets = np.append(0, np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered))))
        data = np.frombuffer(b"".join(lowered), np.uint8)
        starts, lengths = split(data, offsets)
        ids, ends = self.memo.spans(data, starts, lengths)
        raw, width = ids.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize
        stops = ends[np.searchsorted(starts, offsets)] * width
        rest = iter(self.tokenizer.encode_batch_fast([t for t, ok in zip(texts, plain, strict=True) if not ok], add_special_tokens=False))
        spans = iter(zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True))
        return [raw[slice(*next(spans))] if ok else np.array(next(rest).ids, self.kind).tobytes() for ok in plain]

    def _merged(self, pieces: list[bytes]) -> list[bytes]:
        """Pieces are merged many at a time; the last token of a piece is told by its id."""
        lines = [b" ".join(pieces[at : at + 64]).decode("latin-1").encode().decode("latin-1").translate(self.letters) for at in range(0, len(pieces), 64)]
        made = [array("I", e.ids) for e in self.merges.encode_batch_fast(lines, add_special_tokens=False)]
        raw = b"".join(x.tobytes() for x in made)
        stops = 4 * (np.flatnonzero(self.ends[np.frombuffer(raw, "<u4")]) + 1)
        return [raw[a:b] for a, b in zip([0, *stops[:-1].tolist()], stops.tolist(), strict=False)]


def split(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the pattern's matches in lowered Latin-1 texts.

    A match is a run of letters, one digit, or a run of anything else but white space. An apostrophe that
    begins a match takes a following s, t, re, ve, m, ll or d.
    """
    n = len(data)
    kind = KINDS[data]
    start = kind == NUMBER
    start[1:] |= kind[1:] != kind[:-1]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    quote = np.flatnonzero((data == 39) & start)
    room = offsets[np.searchsorted(offsets, quote, side="right")] - quote if len(quote) else quote
    padded = np.append(data, [0, 0])
    a, b = padded[quote + 1], padded[quote + 2]
    one = np.isin(a, list(b"stmd")) & (room >= 2)
    two = np.isin(a.astype(int) << 8 | b, [int.from_bytes(x, "big") for x in (b"re", b"ve", b"ll")]) & (room >= 3)
    for some, size in ((quote[one], 2), (quote[two], 3)):
        start[some + 1] = False
        after = some + size
        start[after[after < n]] = True
    starts = np.flatnonzero(start)
    lengths = np.diff(np.append(starts, n))
    words = kind[starts] != SPACE
    return starts[words], lengths[words]


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


@lru_cache(maxsize=4)
def dictionary(folder: str, sha256: str) -> bytes:
    """The store's dictionary, checked against the hash that its shards keep."""
    system, path = fs.FileSystem.from_uri(f"{folder}/dictionary-{sha256}")
    with system.open_input_stream(path) as f:
        found = f.read()
    if hashlib.sha256(found).hexdigest() != sha256:
        raise ValueError(f"the dictionary in {folder} is not the one its shards were written with")
    return found


def shared(data: bytes) -> dict:
    return {"dict_data": zstandard.ZstdCompressionDict(data)} if data else {}


def train(docs: DataFrame, path: str, end_id: int) -> bytes:
    """A dictionary from the serialized ids of a bounded sample of documents; no bytes for an empty table.

    Where the sample is too small to train on, its own bytes are the dictionary.
    """
    share = min(SAMPLE_ROWS / max(docs.count(), 1), 1.0)
    docs = docs.where(F.xxhash64("doc_id", "text") % 1_000_003 < F.lit(int(share * 2_000_005) - 1_000_002))
    docs = docs.where(F.char_length("text") <= SAMPLE_CHARS).limit(2 * SAMPLE_ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = np.array([end_id], encoder.kind).tobytes()
        samples = [ids + end for b in batches for ids in encoder.encode(b.column("text").to_pylist())]
        try:
            made = zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes() if samples else b""
        except zstandard.ZstdError:
            made = b"".join(samples)[:DICTIONARY_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([made])], ["dictionary"])

    rows = docs.select("text").mapInArrow(run, "dictionary binary").collect()  # one row of one task
    return bytes(rows[0].dictionary) if rows else b""


def write(docs: DataFrame, folder: str, path: str, end_id: int = END_ID) -> None:
    """Write the ids of every row's whole text, and ``end_id`` after each, as a store in a new ``folder`` that all executors share.

    ``path`` names a vocabulary file that every executor has. Documents are in ascending id order,
    nulls last, rows of one id in the order of a hash of their text; a repeated row is written
    repeatedly. A null or empty text has the end id alone. An empty table gives an index without rows. A very long
    text is one frame, so a task holds its ids at once. Columns but ``doc_id`` and ``text`` are not read.
    """
    docs = id_and_text(docs)
    kind = dict(docs.dtypes)["doc_id"]
    data = train(docs, path, end_id)
    sha256 = hashlib.sha256(data)
    system, place = fs.FileSystem.from_uri(folder)
    system.create_dir(f"{place}/shards")
    with system.open_output_stream(f"{place}/dictionary-{sha256.hexdigest()}") as f:
        f.write(data)
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = docs.repartitionByRange(*order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
    digest, hexdigest = sha256.digest(), sha256.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(path)
        end = np.array([end_id], encoder.kind).tobytes()
        width = len(end)
        partition = TaskContext.get().partitionId()  # type: ignore[union-attr]
        packer = zstandard.ZstdCompressor(level=LEVEL, **shared(dictionary(folder, hexdigest)))
        system, place = fs.FileSystem.from_uri(folder)
        name = f"shards/{partition:07d}-{uuid.uuid4().hex}"
        offset, before, out = HEADER_BYTES, 0, None
        try:
            for batch in batches:
                for part in chunks(batch):
                    if out is None:
                        out = system.open_output_stream(f"{place}/{name}")
                        out.write(MARK + digest + bytes([width]))
                    ids = [x + end for x in encoder.encode(part.column("text").to_pylist())]
                    frames = [packer.compress(x) for x in ids]
                    out.write(b"".join(frames))
                    sizes = np.fromiter(map(len, frames), np.int64, len(frames))
                    counts = np.fromiter(map(len, ids), np.int64, len(ids)) // width
                    n = len(frames)
                    columns = [np.full(n, partition), offset + np.cumsum(sizes) - sizes, sizes, before + np.cumsum(counts) - counts, counts]
                    offset, before = offset + int(sizes.sum()), before + int(counts.sum())
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([name] * n), *map(pa.array, columns)], names)
        finally:
            if out is not None:
                out.close()

    names = ["doc_id", "file", "shard", "offset", "size", "before", "n_tokens"]
    made = ordered.mapInArrow(run, f"doc_id {kind}, file string, " + ", ".join(f"{c} long" for c in names[2:]))
    made.write.parquet(f"{folder}/index")


def frames(part: pa.RecordBatch, folder: str) -> Iterator[tuple[int, bytes, int]]:
    """Row, ids as bytes and bytes per id of each document that the index rows name; neighbours in a file are read together."""
    system, place = fs.FileSystem.from_uri(folder)
    names, offsets, sizes = (part.column(c).to_pylist() for c in ("file", "offset", "size"))
    row = 0
    while row < len(names):
        with system.open_input_file(f"{place}/{names[row]}") as f:
            header = f.read(HEADER_BYTES)
            if header[: len(MARK)] != MARK:
                raise ValueError(f"{names[row]} is no shard of token ids")
            opener = zstandard.ZstdDecompressor(**shared(dictionary(folder, header[len(MARK) : -1].hex())))
            name = names[row]
            while row < len(names) and names[row] == name:
                last, start = row + 1, offsets[row]
                while last < len(names) and names[last] == name and offsets[last] == offsets[last - 1] + sizes[last - 1] and offsets[last] + sizes[last] - start <= READ_BYTES:
                    last += 1
                f.seek(start)
                data = memoryview(f.read(offsets[last - 1] + sizes[last - 1] - start))
                for row in range(row, last):
                    yield row, opener.decompress(data[offsets[row] - start : offsets[row] - start + sizes[row]]), header[-1]
                row = last


def read(spark: SparkSession, folder: str, wanted: DataFrame | None = None, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of a store, or of those whose ids ``wanted`` has, and the ``ids`` on request.

    All but ``doc_id`` and ``start`` come from the decompressed frame; ``start`` is the number of ids of all documents before it.
    The offsets before a shard are a sum over one row per shard. Asked for a few documents, a task reads their frames alone.
    """
    index = spark.read.parquet(f"{folder}/index")
    bases = [(r.shard, r.n) for r in index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").toLocalIterator()]  # a row per shard
    starts = np.cumsum([0] + [n for _, n in bases]).tolist()
    base = spark.createDataFrame([(shard, start) for (shard, _), start in zip(bases, starts)], "shard long, base long")
    if wanted is not None:
        same = F.col("doc_id").eqNullSafe(F.col("wanted_id"))
        index = index.join(wanted.select(F.col("doc_id").alias("wanted_id")).distinct(), same, "left_semi")
    kind = dict(index.dtypes)["doc_id"]
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = np.asarray(batch.column("base")) + np.asarray(batch.column("before"))
            rows, counts, sums, lists, size = [], [], [], [], 0
            for row, data, width in frames(batch, folder):
                ids = np.frombuffer(data, f"<u{width}").astype("<u4")
                rows.append(row)
                counts.append(len(ids))
                sums.append(zlib.crc32(ids))
                lists.append(ids.astype(np.int32) if with_ids else None)
                size += len(ids)
                if with_ids and size > READ_BYTES:
                    yield out(batch, start, rows, counts, sums, lists)
                    rows, counts, sums, lists, size = [], [], [], [], 0
            if rows:
                yield out(batch, start, rows, counts, sums, lists)

    def out(batch: pa.RecordBatch, start: np.ndarray, rows: list, counts: list, sums: list, lists: list) -> pa.RecordBatch:
        columns = [batch.column("doc_id").take(pa.array(rows)), pa.array(start[rows]), pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
        return pa.RecordBatch.from_arrays(columns + [pa.array(lists, pa.list_(pa.int32()))] * with_ids, names)

    made = index.join(F.broadcast(base), "shard").select("doc_id", "file", "offset", "size", "before", "base")
    return made.mapInArrow(run, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
