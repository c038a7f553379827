"""CRC-32C of many byte runs at once, with numpy.

The checksum is linear: a block's value is the XOR of one table entry for each byte,
and a value is carried over following blocks by a fixed linear map.  All blocks of all
runs are looked up together, then carried by powers of that map (bit by bit of the
number of blocks that follow) and combined per run.
"""

from __future__ import annotations

from functools import cache

import numpy as np

POLYNOMIAL = 0x82F63B78  # Castagnoli, reflected
BLOCK = 256
ONES = np.uint32(0xFFFFFFFF)
AT_ONCE = 1 << 12  # blocks looked up together


@cache
def _bytes_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(POLYNOMIAL), table >> 1).astype(np.uint32)
    return table


def _next(state: np.ndarray) -> np.ndarray:
    """The state after one zero byte."""
    return _bytes_table()[state & 255] ^ (state >> 8)


@cache
def _block_table() -> np.ndarray:
    """Entry of each byte at each place of a block, flat."""
    table = np.empty((BLOCK, 256), np.uint32)
    table[BLOCK - 1] = _bytes_table()
    for at in range(BLOCK - 2, -1, -1):
        table[at] = _next(table[at + 1])
    return table.ravel()


@cache
def _carry(power: int) -> np.ndarray:
    """Tables, by byte of the state, of the map over ``2 ** power`` blocks."""
    table = (np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)).astype(np.uint32)
    if power:
        return _apply(power - 1, _apply(power - 1, table))
    for _ in range(BLOCK):
        table = _next(table)
    return table


def _apply(power: int, state: np.ndarray) -> np.ndarray:
    t = _carry(power)
    return t[0][state & 255] ^ t[1][(state >> 8) & 255] ^ t[2][(state >> 16) & 255] ^ t[3][state >> 24]


def crc32c(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Checksum of each run ``data[start:end]``; every run has four bytes at least."""
    counts = -(-(ends - starts) // BLOCK)
    last = np.cumsum(counts)
    padded = np.zeros(int(last[-1]) * BLOCK if len(last) else 0, np.uint8)
    for s, e, to in zip(starts.tolist(), ends.tolist(), (last * BLOCK).tolist(), strict=True):
        padded[to - (e - s) : to] = data[s:e]  # zeros in front change nothing
        padded[to - (e - s) : to - (e - s) + 4] ^= 255  # the start value of all ones
    blocks = padded.reshape(-1, BLOCK)
    values = np.empty(len(blocks), np.uint32)
    places = np.arange(BLOCK, dtype=np.int32) * 256
    for k in range(0, len(blocks), AT_ONCE):
        values[k : k + AT_ONCE] = np.bitwise_xor.reduce(_block_table().take(blocks[k : k + AT_ONCE] + places), axis=1)
    follow = np.repeat(last, counts) - 1 - np.arange(len(blocks))
    for power in range(int(follow.max()).bit_length() if len(follow) else 0):
        carried = (follow >> power) & 1 == 1
        values[carried] = _apply(power, values[carried])
    return (np.bitwise_xor.reduceat(values, last - counts) if len(last) else values) ^ ONES


def masked(checksums: np.ndarray) -> np.ndarray:
    """Rotated and shifted by a constant, as is usual where checksummed data hold checksums."""
    with np.errstate(over="ignore"):
        return ((checksums >> np.uint32(15)) | (checksums << np.uint32(17))) + np.uint32(0xA282EAD8)
