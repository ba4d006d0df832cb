"""CRC-32C (Castagnoli) over many byte strings at once, with numpy.

A CRC without start and end value is linear over GF(2).  Two things follow:

* a byte string can be cut into equal lanes, the lanes run side by side, and the
  lane values be merged pairwise by "shift and xor";
* the checksum of a payload is the xor of one contribution per chunk, where a
  contribution depends only on the chunk and on the number of bytes after it.
  Xor is what ``bit_xor`` sums up in Spark, in any order and on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

# Reflected CRC-32C polynomial, start and end value.
POLYNOMIAL = 0x82F63B78
ALL_ONES = 0xFFFFFFFF

_LANE_BYTES = 1024
_BITS = np.arange(32, dtype=np.uint32)


# Tables made on first use, per Python worker.
_TABLES: dict = {}


def _word_tables() -> tuple[np.ndarray, np.ndarray]:
    """Tables advancing the low and the high half of a register by four bytes."""
    if "words" not in _TABLES:
        _TABLES["words"] = _make_word_tables()
    return _TABLES["words"]


def _make_word_tables() -> tuple[np.ndarray, np.ndarray]:
    value = np.arange(65536, dtype=np.uint32)
    for _ in range(16):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(POLYNOMIAL), value >> 1)
    high = value.copy()  # sixteen zero bits pushed through
    low = (high >> np.uint32(16)) ^ high[high & np.uint32(0xFFFF)]
    return low, high


def _apply(columns: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Multiply 32-bit vectors by a 32x32 bit matrix given as 32 columns."""
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where((values >> np.uint32(bit)) & np.uint32(1), columns[bit], np.uint32(0))
    return out


def _zero_bytes_tables(log2_bytes: int) -> np.ndarray:
    """The same operator as four tables, one per byte of the register."""
    if log2_bytes not in _TABLES:
        columns = _zero_bytes_matrix(log2_bytes)
        byte = np.arange(256, dtype=np.uint32)
        _TABLES[log2_bytes] = np.stack(
            [_apply(columns, byte << np.uint32(8 * place)) for place in range(4)]
        )
    return _TABLES[log2_bytes]


def _append_zeros(log2_bytes: int, values: np.ndarray) -> np.ndarray:
    tables = _zero_bytes_tables(log2_bytes)
    out = tables[0][values & np.uint32(0xFF)]
    for place in range(1, 4):
        out = out ^ tables[place][(values >> np.uint32(8 * place)) & np.uint32(0xFF)]
    return out


def _zero_bytes_matrix(log2_bytes: int) -> np.ndarray:
    """Columns of the operator that appends 2**log2_bytes zero bytes."""
    columns = np.uint32(1) << _BITS
    for _ in range(8):
        columns = np.where(
            columns & 1, (columns >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), columns >> np.uint32(1)
        )
    for _ in range(log2_bytes):
        columns = _apply(columns, columns)
    return columns


def shift(values: np.ndarray, zero_bytes: np.ndarray) -> np.ndarray:
    """Raw CRC registers after ``zero_bytes`` further zero bytes, per element."""
    values = np.asarray(values, dtype=np.uint32).copy()
    zero_bytes = np.asarray(zero_bytes, dtype=np.int64)
    level = 0
    while np.any(zero_bytes >> level):
        moved = (zero_bytes >> level) & 1 == 1
        if moved.any():
            values[moved] = _append_zeros(level, values[moved])
        level += 1
    return values


def _raw(padded: np.ndarray) -> np.ndarray:
    """Raw registers of rows of equal length, a power of two times the lane size."""
    n, width = padded.shape
    lane = min(_LANE_BYTES, width)
    words = np.ascontiguousarray(padded.reshape(n * (width // lane), lane).view("<u4").T)
    low, high = _word_tables()
    register = np.zeros(words.shape[1], dtype=np.uint32)
    for word in words:
        register ^= word
        register = low[register & np.uint32(0xFFFF)] ^ high[register >> np.uint32(16)]
    register = register.reshape(n, width // lane)
    level = int(lane).bit_length() - 1
    while register.shape[1] > 1:
        register = _append_zeros(level, register[:, 0::2]) ^ register[:, 1::2]
        level += 1
    return register[:, 0]


def crc32c_many(parts: Sequence[bytes]) -> np.ndarray:
    """CRC-32C of each byte string, as uint32."""
    lengths = np.fromiter((len(p) for p in parts), dtype=np.int64, count=len(parts))
    out = np.zeros(len(parts), dtype=np.uint32)
    # Zero bytes in front do not change a raw register, so strings of one size
    # class share a matrix that is padded at the front.
    classes = np.array([max(4, 1 << max(0, int(n) - 1).bit_length()) for n in lengths], dtype=np.int64)
    for width in np.unique(classes):
        members = np.flatnonzero(classes == width)
        per_round = max(1, (32 << 20) // int(width))
        for start in range(0, len(members), per_round):
            chosen = members[start : start + per_round]
            padded = np.zeros((len(chosen), int(width)), dtype=np.uint8)
            for row, index in enumerate(chosen):
                part = parts[index]
                if len(part):
                    padded[row, int(width) - len(part) :] = np.frombuffer(part, dtype=np.uint8)
            out[chosen] = _raw(padded)
    starts = shift(np.full(len(parts), ALL_ONES, dtype=np.uint32), lengths)
    return out ^ starts ^ np.uint32(ALL_ONES)


def crc32c(data: bytes) -> int:
    return int(crc32c_many([data])[0])


def contribution(checksums: np.ndarray, bytes_after: np.ndarray) -> np.ndarray:
    """Share of each part in the checksum of the whole.

    For parts in a row, crc(whole) is the xor of each part's checksum moved over
    the bytes that follow it.
    """
    return shift(checksums, bytes_after)
