"""Token ids of texts whose pieces are encoded apart, each distinct piece once."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tramflow.llm.byte_bpe import unique_pieces
from tramflow.llm.common import ragged

#: Pieces kept per worker, and the longest kept. Neither bears on the ids.
ENTRIES = 200_000
LONGEST = 64


class Memo:
    """Ids of pieces, as bytes of 32-bit integers, by their own bytes. ``encode`` gives those of pieces that are not known yet."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        self.encode = encode
        self.known: dict[bytes, bytes] = {}

    def spans(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans of bytes, one after the other, and span offsets into them."""
        codes, first = unique_pieces(data, starts, lengths)
        raw = data.tobytes()
        pieces = [raw[s:e] for s, e in zip(starts[first].tolist(), (starts[first] + lengths[first]).tolist(), strict=True)]
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > ENTRIES:
            self.known = {p: self.known[p] for p in pieces if p in self.known}  # what is in use stays
        if new:
            self.known.update(zip(new, self.encode(new), strict=True))
        found = list(map(self.known.__getitem__, pieces))
        for piece in new:
            if len(piece) > LONGEST:
                del self.known[piece]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        ids = flat[ragged((np.cumsum(sizes) - sizes)[codes], sizes[codes])]
        return ids, np.append(0, np.cumsum(sizes[codes]))
