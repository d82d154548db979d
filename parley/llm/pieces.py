"""Byte-level BPE applied to the distinct pieces of texts.

A text is cut where no match of the pre-tokenizer's pattern can span the cut, so pieces
can be encoded one by one and the ids concatenated.  Within a block equal pieces are
encoded once; a bounded table per Python worker keeps recent pieces for later blocks.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from parley.llm.common import spread
from parley.llm.words import span_hashes

_B = np.arange(256)
_SPACE = ((_B >= 9) & (_B <= 13)) | (_B == 32)
_LETTER = ((_B >= 0x41) & (_B <= 0x5A)) | ((_B >= 0x61) & (_B <= 0x7A))
_DIGIT = (_B >= 0x30) & (_B <= 0x39)
_MARK = (_B > 32) & (_B < 127) & ~_LETTER & ~_DIGIT
_PLAIN = (_B < 128) & ~_SPACE  # an ASCII character that is not white space
_LEAD2 = (_B >= 0xC3) & (_B <= 0xDF)  # starts a two-byte character beyond U+00BF: never white space
_TAIL = (_B >= 0x80) & (_B <= 0xBF)

#: Pieces kept by a worker's table, and the longest piece it keeps.
TABLE_PIECES = 600_000
TABLE_BYTES = 64


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Starts of the pieces of a block of texts.

    The pattern's matches hold white space only at their start or nowhere else, so a cut
    between a non-space and a following space is safe; so is one between a letter and an
    ASCII mark, which end and start matches of different classes.  Where the character
    before is not known to be no white space there is no cut, only a longer piece.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    plain = _PLAIN[data]
    plain[1:] |= _TAIL[data[1:]] & _LEAD2[data[:-1]]
    cut = np.zeros(n, bool)
    cut[1:] = (plain[:-1] & _SPACE[data[1:]]) | (_LETTER[data[:-1]] & _MARK[data[1:]])
    cut[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(cut)


class PieceEncoder:
    """Encodes blocks of texts; ``encode`` maps a list of pieces to the ids of each, as
    little-endian unsigned 32-bit integers."""

    def __init__(self, encode: Callable[[list[bytes]], list[bytes]]):
        self._encode = encode
        self._table: dict[bytes, bytes] = {}

    def _ids(self, pieces: list[bytes]) -> list[bytes]:
        table = self._table
        new = [p for p in dict.fromkeys(pieces) if p not in table]
        got = dict(zip(new, self._encode(new))) if new else {}
        out = [got[p] if p in got else table[p] for p in pieces]
        if len(table) + len(got) > TABLE_PIECES:
            table.clear()
        table.update((p, i) for p, i in got.items() if len(p) <= TABLE_BYTES)
        return out

    def block(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts as uint32, offsets of each text's ids)."""
        starts = cuts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.append(starts[1:], len(data))
        lengths = ends - starts
        _, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        same = np.array_equal(lengths, lengths[first][which]) and np.array_equal(data, data[spread(lengths, starts[first][which])])
        if not same:  # two different pieces share a hash: every piece on its own
            first = which = np.arange(len(starts))
        raw = data.tobytes()
        ids = self._ids([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
        flat = np.frombuffer(b"".join(ids), "<u4")
        n = np.array([len(x) >> 2 for x in ids], np.int64)
        at = np.cumsum(n) - n
        out = flat[spread(n[which], at[which])]
        ends_at = np.concatenate(([0], np.cumsum(n[which])))
        return out, ends_at[np.searchsorted(starts, offsets)]
