"""CRC-32C of many byte strings at once, and its masked form for record files."""

from __future__ import annotations

import numpy as np

_BLOCK = 256


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0x82F63B78), table >> 1)
    return table


def _apply(op: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return op[0][crc & 255] ^ op[1][(crc >> 8) & 255] ^ op[2][(crc >> 16) & 255] ^ op[3][crc >> 24]


def _operators() -> list[np.ndarray]:
    """Item k advances a checksum over 2**k zero bytes."""
    table = _byte_table()
    each = np.array([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)])
    ops = [table[each & 255] ^ (each >> np.uint32(8))]
    for _ in range(39):
        ops.append(_apply(ops[-1], ops[-1]))
    return ops


_OPS = _operators()


def crc32c(messages: list[bytes]) -> np.ndarray:
    """Checksums of the messages: blocks in step with one another, then the blocks of
    each message in order. A message is aligned to the end of its blocks, as leading
    zeros leave a checksum without start value unchanged; the start value is added."""
    if not messages:
        return np.zeros(0, np.uint32)
    sizes = np.fromiter(map(len, messages), np.int64, len(messages))
    blocks = np.maximum(1, -(-sizes // _BLOCK))
    ends = np.cumsum(blocks)
    padded = bytearray()
    for m, n, b in zip(messages, sizes.tolist(), blocks.tolist(), strict=True):
        padded += bytes(b * _BLOCK - n)
        padded += m
    words = np.frombuffer(padded, "<u4").reshape(-1, _BLOCK // 4)
    part = np.zeros(len(words), np.uint32)
    for i in range(words.shape[1]):
        part = _apply(_OPS[2], part ^ words[:, i])
    order = np.argsort(-blocks, kind="stable")
    begin, left = (ends - blocks)[order], blocks[order]
    crc = np.zeros(len(messages), np.uint32)
    active = len(messages)
    for j in range(int(left[0])):
        active = int(np.searchsorted(-left, -j, side="left")) if j else active
        crc[:active] = _apply(_OPS[8], crc[:active]) ^ part[begin[:active] + j]
    out = np.empty_like(crc)
    out[order] = crc
    start = np.full(len(messages), 0xFFFFFFFF, np.uint32)
    for k in range(int(sizes.max()).bit_length()):
        has = (sizes >> k) & 1 == 1
        start[has] = _apply(_OPS[k], start[has])
    return out ^ start ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    """The rotation and constant of the public record format."""
    crc = crc.astype(np.uint32)
    return ((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(0xA282EAD8)
