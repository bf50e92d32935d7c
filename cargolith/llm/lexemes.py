"""Words of letters, digits and non-ASCII characters, found at byte level (operators 12 and 13).

A word is a maximal run of the bytes 0-9, A-Z, a-z and 0x80-0xFF; only A-Z are lower-cased. In UTF-8 that is
the same as runs of ASCII letters and digits and of all characters from U+0080 on.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cargolith.llm.common import text_slices

_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Bytes of texts worked on at once; a longer text is cut between words.
SLICE = 1 << 19
#: Words of more bytes than this go through zlib one by one.
_LONG = 200


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def slices(column: pa.Array, overlap: bool = False, limit: int = SLICE) -> Iterator[tuple[int, np.ndarray, np.ndarray, bool]]:
    """(first row, lower-cased bytes, offsets, joined) of runs of texts of about ``limit`` bytes; NULL is empty.

    A text far longer than ``limit`` comes in several parts, each ending with a whole word. With ``overlap`` a
    part starts with the last word of the part before it, which ``joined`` says.
    """
    for i, j, data, offs in text_slices(column, limit):
        if j - i > 1 or len(data) <= 2 * limit:
            yield i, _LOWER[data], offs, False
            continue
        at = end = 0
        while end < len(data):
            stop = min(len(data), end + limit)
            rest = _WORD[data[stop:]]
            if len(rest) and rest[0]:
                gap = int(rest.argmin())
                stop = stop + gap if gap else len(data)
            part = data[at:stop]
            yield i, _LOWER[part], np.array([0, len(part)]), at < end
            end = stop
            word = np.flatnonzero(_WORD[part]) if overlap else ()
            if not len(word):
                at = stop
                continue
            before = np.flatnonzero(~_WORD[part[: word[-1]]])
            at += int(before[-1]) + 1 if len(before) else 0


def spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end byte of each word, and the text each word is in."""
    n = len(data)
    word = _WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = np.flatnonzero(word & (np.concatenate(([True], ~word[:-1]))[:n] | edge[:n]))
    ends = np.flatnonzero(word & (np.concatenate((~word[1:], [True]))[-n:] | edge[1:])) + 1 if n else starts
    return starts, ends, np.searchsorted(offs, starts, "right") - 1


def crc_states(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """CRC-32 register after each span's bytes, from ``first`` on (before the last inversion)."""
    sizes = np.minimum(ends - starts, _LONG + 1).astype(np.uint8)
    order = np.argsort(sizes, kind="stable")[::-1]
    state, at = first[order].astype(np.uint32), starts[order]
    live = np.cumsum(np.bincount(sizes, minlength=_LONG + 2)[::-1])[::-1]  # spans of at least k bytes
    long = int(live[_LONG + 1])
    for k in range(int(sizes.max()) if len(sizes) else 0):
        n = int(live[k + 1])
        if n <= long:
            break
        now = state[long:n]
        state[long:n] = _CRC[(now ^ data[at[long:n] + k]) & np.uint32(255)] ^ (now >> np.uint32(8))
    for i in range(long):
        w = order[i]
        state[i] = zlib.crc32(data[starts[w] : ends[w]].tobytes(), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    out = np.empty(len(state), np.uint32)
    out[order] = state
    return out


def after_blank(state: np.ndarray) -> np.ndarray:
    """The register after one more byte, a blank."""
    return _CRC[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))
