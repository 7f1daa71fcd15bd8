"""CRC-32C of many byte strings at once, in numpy.

Each string is cut into chunks (zeros before the first, which a zero state
ignores), the chunks of all strings advance together eight bytes a step, and
chunk results are combined by the linear map that stands for a chunk of zeros.
"""

from __future__ import annotations

import numpy as np

_POLYNOMIAL = 0x82F63B78  # reversed Castagnoli polynomial
_CHUNK = 256
_MASK_DELTA = 0xA282EAD8


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(_POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _slices() -> np.ndarray:
    """Row k: the effect of a byte that k more zero bytes follow."""
    rows = [_byte_table()]
    for _ in range(7):
        rows.append((rows[-1] >> 8) ^ rows[0][rows[-1] & 255])
    return np.array(rows)


_T = _slices()


def _apply(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    return (
        tables[0][state & 255] ^ tables[1][(state >> 8) & 255] ^ tables[2][(state >> 16) & 255] ^ tables[3][state >> 24]
    )


def _zeros_map() -> list[np.ndarray]:
    """Entry b: the map of a state over 2**b zero bytes, as four byte tables."""
    lanes = np.arange(256, dtype=np.uint32)
    inputs = np.array([lanes << np.uint32(8 * k) for k in range(4)], np.uint32)
    maps = [(inputs >> 8) ^ _T[0][inputs & 255]]
    for _ in range(39):
        maps.append(_apply(maps[-1], maps[-1]))
    return maps


_ZEROS = _zeros_map()
_OVER_CHUNK = _ZEROS[_CHUNK.bit_length() - 1]


def crc32c(strings: list[bytes]) -> np.ndarray:
    """CRC-32C of each string, as unsigned 32-bit integers."""
    sizes = np.array([len(s) for s in strings], np.int64)
    chunks = -(-sizes // _CHUNK)
    ends = np.cumsum(chunks)
    total = int(ends[-1]) if len(strings) else 0
    data = np.zeros(total * _CHUNK, np.uint8)
    for s, end, size in zip(strings, (ends * _CHUNK).tolist(), sizes.tolist()):
        data[end - size : end] = np.frombuffer(s, np.uint8)
    steps = np.ascontiguousarray(data.view("<u4").reshape(total, _CHUNK // 4).T)
    state = np.zeros(total, np.uint32)
    for k in range(0, _CHUNK // 4, 2):
        a, b = state ^ steps[k], steps[k + 1]
        state = (
            _T[7][a & 255] ^ _T[6][(a >> 8) & 255] ^ _T[5][(a >> 16) & 255] ^ _T[4][a >> 24]
            ^ _T[3][b & 255] ^ _T[2][(b >> 8) & 255] ^ _T[1][(b >> 16) & 255] ^ _T[0][b >> 24]
        )
    out = np.zeros(len(strings), np.uint32)
    start = ends - chunks
    for k in range(int(chunks.max(initial=0))):
        on = np.flatnonzero(chunks > k)
        out[on] = _apply(_OVER_CHUNK, out[on]) ^ state[start[on] + k]
    ones = np.full(len(strings), 0xFFFFFFFF, np.uint32)
    for b in range(int(sizes.max(initial=0)).bit_length()):
        on = np.flatnonzero((sizes >> b) & 1)
        ones[on] = _apply(_ZEROS[b], ones[on])
    return out ^ ones ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """The checksum as stored: rotated and shifted, so that it never covers itself."""
    crc = crc.astype(np.uint64)
    rotated = ((crc >> np.uint64(15)) | (crc << np.uint64(17))) & np.uint64(0xFFFFFFFF)
    return ((rotated + np.uint64(_MASK_DELTA)) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
