"""CRC-32C of many byte strings at once, and the masked form record files use."""

from __future__ import annotations

import numpy as np

#: The reflected Castagnoli polynomial and the mask's added constant.
_POLYNOMIAL = 0x82F63B78
_MASK_DELTA = 0xA282EAD8
_LANE = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ (np.uint32(_POLYNOMIAL) * (table & np.uint32(1)))
    return table


_TABLE = _byte_table()
_ONE = _TABLE[np.arange(65536) & 255] ^ (np.arange(65536, dtype=np.uint32) >> np.uint32(8))
#: Two bytes at a time.
_PAIR_TABLE = (_ONE >> np.uint32(8)) ^ _TABLE[_ONE & np.uint32(255)]


def _shift_tables(count: int) -> list[np.ndarray]:
    """Table k appends 2^k lanes of zero bytes to a checksum, a byte of the checksum at a time."""
    basis = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(_LANE):
        basis = (basis >> np.uint32(8)) ^ _TABLE[basis & np.uint32(255)]
    out = []
    for _ in range(count):
        values = np.zeros((4, 256), np.uint32)
        for byte in range(4):
            for bit in range(8):
                on = (np.arange(256) >> bit & 1).astype(bool)
                values[byte, on] ^= basis[8 * byte + bit]
        out.append(values)
        basis = _apply(values, basis)
    return out


def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    return (
        table[0][crc & low] ^ table[1][crc >> np.uint32(8) & low]
        ^ table[2][crc >> np.uint32(16) & low] ^ table[3][crc >> np.uint32(24)]
    )


_SHIFTS = _shift_tables(26)


def crc32c_many(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32C of every ``data[start : start + length]`` (bytes) as uint32; an empty one gives 0.

    Each string is cut into lanes of 64 bytes that advance together; lanes then move past the
    bytes after them by table and are summed. Work and memory are linear in the bytes given.
    """
    starts, lengths = np.asarray(starts, np.int64), np.asarray(lengths, np.int64)
    lanes = np.maximum(-(-lengths // _LANE), 1)
    first = np.concatenate(([0], np.cumsum(lanes)[:-1])) if len(lanes) else np.zeros(0, np.int64)
    total = int(lanes.sum())
    grid = np.zeros(total * _LANE, np.uint8)
    # Strings stand at the end of their lanes: zero bytes before them leave the register at 0.
    begin = (first + lanes) * _LANE - lengths
    for to, at, size in zip(begin.tolist(), starts.tolist(), lengths.tolist()):
        grid[to : to + size] = data[at : at + size]
    # The register starts with all ones: that flips the first four bytes of the string.
    for k in range(4):
        has = lengths > k
        grid[begin[has] + k] ^= np.uint8(255)
    columns = np.ascontiguousarray(grid.view("<u2").reshape(total, _LANE // 2).T)
    crc = np.zeros(total, np.uint32)
    for column in columns:
        crc = (crc >> np.uint32(16)) ^ _PAIR_TABLE[crc.astype(np.uint16) ^ column]
    after = np.repeat(lanes + first, lanes) - 1 - np.arange(total)
    for k, table in enumerate(_SHIFTS):
        move = (after >> k) & 1 == 1
        if not move.any():
            if not (after >> k).any():
                break
            continue
        crc[move] = _apply(table, crc[move])
    out = np.bitwise_xor.reduceat(crc, first) if total and len(lanes) else np.zeros(0, np.uint32)
    # Strings under four bytes flip only their own bytes; the rest of the ones pass to the result.
    for n in range(4):
        short = lengths == n
        if short.any():
            out[short] ^= np.uint32(0xFFFFFFFF) >> np.uint32(8 * n)
    return ~out


def masked(crc: np.ndarray) -> np.ndarray:
    """Rotated and offset, so that a checksum stored beside data that holds checksums differs."""
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK_DELTA)
