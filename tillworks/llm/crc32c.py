"""CRC-32C, vectorised, and the masked form that framed record files carry."""

from __future__ import annotations

import numpy as np

_POLYNOMIAL = np.uint32(0x82F63B78)  # fixed value: Castagnoli, reflected
_MASK = 0xA282EAD8  # fixed value of the record format
_BLOCK = 1024


def _tables() -> np.ndarray:
    """``[k, byte]``: the checksum state after this byte and k zero bytes, from state 0."""
    row = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        row = np.where(row & 1, (row >> np.uint32(1)) ^ _POLYNOMIAL, row >> np.uint32(1))
    out = np.empty((_BLOCK, 256), np.uint32)
    out[0] = row
    for k in range(1, _BLOCK):
        out[k] = (out[k - 1] >> np.uint32(8)) ^ row[out[k - 1] & np.uint32(0xFF)]
    return out


_AFTER = _tables()
_IN_BLOCK = np.ascontiguousarray(_AFTER[::-1])
_FLAT = _IN_BLOCK.reshape(-1)
_PLACES = np.arange(_BLOCK) * 256
_BYTE = _AFTER[0].tolist()
_BLOCK_ON = _IN_BLOCK[:4].tolist()  # what each byte of a state becomes after a block
_SHORT = 24  # bytes up to which a plain loop is faster


def crc32c(data: bytes) -> int:
    """Checksum of ``data``."""
    if len(data) <= _SHORT:
        state = 0xFFFFFFFF
        for b in data:
            state = (state >> 8) ^ _BYTE[(state ^ b) & 0xFF]
        return state ^ 0xFFFFFFFF
    values = np.frombuffer(bytearray(data), np.uint8)
    values[:4] ^= 0xFF  # the initial state
    head, state = len(data) % _BLOCK, 0
    if head:  # zero bytes in front would leave state 0 as it is
        state = int(np.bitwise_xor.reduce(_FLAT.take(_PLACES[-head:] + values[:head])))
    if head < len(data):
        zero, one, two, three = _BLOCK_ON
        for block in np.bitwise_xor.reduce(_FLAT.take(_PLACES + values[head:].reshape(-1, _BLOCK)), axis=1).tolist():
            state = zero[state & 0xFF] ^ one[state >> 8 & 0xFF] ^ two[state >> 16 & 0xFF] ^ three[state >> 24] ^ block
    return state ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    """Rotated and offset checksum, so that checksums of data holding checksums stay sound."""
    crc = crc32c(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF
