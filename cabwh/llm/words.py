"""Words of whole texts by Arrow kernels, and CRC-32 of joined strings without joining them.

A batch is cut into slices of about ``SLICE_BYTES`` of text (a longer text is a slice of its own), so the working
memory does not depend on how many rows a batch has. A slice's words come as indices into its distinct words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
#: Joined strings up to this length have a table of their own.
_DIRECT = 64


class Words(NamedTuple):
    """The words of consecutive rows: ``distinct[index]``, in order; row r has ``count[r]`` of them."""

    distinct: pa.Array
    index: np.ndarray
    count: np.ndarray


def slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) of each slice of a string column; null counts as empty."""
    texts = pc.fill_null(texts, "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        begin = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, begin + SLICE_BYTES, side="right")))
        yield at, texts.slice(at, stop - at)
        at = stop


def words_of(texts: pa.Array, separators: str) -> Words:
    """Lower-case A-Z and split at ``separators`` (a pattern of what stands between words)."""
    parts = pc.split_pattern_regex(pc.ascii_lower(texts), separators)
    flat = pc.list_flatten(parts).dictionary_encode()
    index = flat.indices.to_numpy(zero_copy_only=False)
    count = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(flat.dictionary, pa.scalar("", flat.dictionary.type)).as_py()
    if empty < 0:
        return Words(flat.dictionary, index.astype(np.int64), count)
    real = index != empty                                # separators at an end leave an empty part
    before = np.concatenate(([0], np.cumsum(real)))
    ends = np.cumsum(count)
    return Words(flat.dictionary, index[real].astype(np.int64), before[ends] - before[ends - count])


def bytes_of(strings: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string array without nulls (slices of its own buffers)."""
    if not len(strings):
        return []
    _, offsets, data = strings.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[strings.offset: strings.offset + len(strings) + 1].tolist()
    data = data.to_pybytes() if data is not None else b""
    return [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def crc32_each(strings: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, strings), dtype=np.uint32, count=len(strings))


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return (table[0][crc & 255] ^ table[1][crc >> 8 & 255] ^ table[2][crc >> 16 & 255] ^ table[3][crc >> 24])


def _tables() -> tuple[list[np.ndarray], np.ndarray]:
    """What following zero bytes do to a checksum, as four tables by its bytes: 2**k of them, and 0 to ``_DIRECT``."""
    values = np.arange(256, dtype=np.uint32)
    start = np.stack([values << np.uint32(8 * k) for k in range(4)])
    zero = zlib.crc32(b"\0")
    one = np.array([[zlib.crc32(b"\0", int(v)) ^ zero for v in row] for row in start], dtype=np.uint32)
    powers = [one]
    while len(powers) < 31:
        powers.append(_apply(powers[-1], powers[-1]))
    direct = [start]
    while len(direct) <= _DIRECT:
        direct.append(_apply(one, direct[-1]))
    return powers, np.stack(direct, axis=1)              # direct: byte place, length, byte


_POWERS, _BY_LENGTH = _tables()


def crc32_joined(left: np.ndarray, right: np.ndarray, right_length: np.ndarray) -> np.ndarray:
    """The CRC-32 of ``a + b`` from those of a and b and the bytes of b, element by element."""
    out = np.empty(len(left), dtype=np.uint32)
    short = right_length <= _DIRECT
    n, c = right_length[short], left[short]
    out[short] = (_BY_LENGTH[0, n, c & 255] ^ _BY_LENGTH[1, n, c >> 8 & 255]
                  ^ _BY_LENGTH[2, n, c >> 16 & 255] ^ _BY_LENGTH[3, n, c >> 24])
    if not short.all():
        n, c = right_length[~short], left[~short]
        for k, table in enumerate(_POWERS):
            moved = n >> k & 1 == 1
            c[moved] = _apply(table, c[moved])
        out[~short] = c
    return out ^ right
