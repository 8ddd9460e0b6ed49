"""Token counts by field or section: offset-mapped attribution.

A whole document is encoded once. The tokens' byte lengths give their character spans, which are
joined to the sections' spans; both are in order, so the join is two binary searches. A
token that crosses a border is allocated by an explicit rule.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tramflow.llm.byte_bpe import encode_texts, vocabulary
from tramflow.llm.common import chunks, id_and_text, ragged, text_bytes

#: "most": the section with most of the token's characters, the earlier of equals; "first": that of its first character there.
RULES = ("most", "first")
#: Sections of a column of texts: row, first character and the one after the last, by row and in order, not overlapping.
Sections = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def lines(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each line with the line feed that ends it; lines tile a text, an empty text has none."""
    data, offsets = text_bytes(column)
    chars = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    ends = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, offsets[1:][np.diff(offsets) > 0]])).astype(np.int64)
    row = np.searchsorted(offsets, ends - 1, side="right") - 1
    starts = np.append(0, ends[:-1])[: len(ends)]
    base = chars[offsets[row]]
    return row, chars[starts] - base, chars[ends] - base


def allocate(first: np.ndarray, last: np.ndarray, begins: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token span (-1: none) and whether the token meets more than one section."""
    low = np.searchsorted(ends, first, side="right")
    high = np.searchsorted(begins, last, side="left") - 1
    out = np.where(low <= high, low, -1)
    crossing = np.flatnonzero(high > low)
    if rule == "most" and len(crossing):
        size = high[crossing] - low[crossing] + 1
        section, token = ragged(low[crossing], size), np.repeat(crossing, size)
        shared = np.minimum(ends[section], last[token]) - np.maximum(begins[section], first[token])
        at = np.cumsum(size) - size
        best = np.repeat(np.maximum.reduceat(shared, at), size) == shared
        where = np.flatnonzero(best)
        out[token[where][::-1]] = section[where][::-1]  # the earliest is written last
    return out, high > low


def section_tokens(docs: DataFrame, path: str, sections: Sections = lines, rule: str = "most") -> DataFrame:
    """``doc_id, section, first_char, last_char, n_tokens, n_crossing`` for every section of every row.

    ``n_tokens`` counts the tokens allocated to the section, ``n_crossing`` those of them that
    cross a border. Tokens outside all sections are counted in a row of section -1, where there are any, so
    a document's counts add up to its tokens. A null or empty text has no rows; repeated rows give
    repeated rows; columns but ``doc_id`` and ``text`` are not read.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    docs = id_and_text(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for part in chunks(batch):
                text = part.column("text")
                data, offsets = text_bytes(text)
                ids, token_edges = encode_texts(text, vocab)
                ends = np.cumsum(vocab.lengths[ids])
                chars = np.cumsum((data & 0xC0) != 0x80)  # the character of byte b is chars[b] - 1
                token_first, token_last = chars[ends - vocab.lengths[ids]] - 1, chars[ends - 1]
                row, first, last = sections(text)
                base = np.append(0, chars)[offsets[:-1]]
                where, crosses = allocate(token_first, token_last, base[row] + first, base[row] + last, rule)
                inside = where >= 0
                count = np.bincount(where[inside], minlength=len(row))
                crossing = np.bincount(where[inside & crosses], minlength=len(row))
                token_row = np.repeat(np.arange(len(part)), np.diff(token_edges))
                outside = np.bincount(token_row[~inside], minlength=len(part))
                lost = np.flatnonzero(outside)
                number = np.arange(len(row)) - np.searchsorted(row, row)
                none = np.full(len(lost), -1)
                columns = [np.concatenate(c) for c in ((row, lost), (number, none), (first, none), (last, none), (count, outside[lost]), (crossing, 0 * lost))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(columns[0])), *(pa.array(c.astype(np.int64)) for c in columns[1:])], names)

    names = ["doc_id", "section", "first_char", "last_char", "n_tokens", "n_crossing"]
    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, " + ", ".join(f"{n} long" for n in names[1:]))
