"""Reproducible randomness: every draw is a hash of a row key and a salt, so it does not depend on partitioning."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# MD5: rotations and constants of its 64 steps, and the state it starts from.
MD5_TURNS = [n for four in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for n in four * 4]
MD5_ADDED = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
MD5_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
# Keys that are hashed together.
HASHED = 65_536


def u(key: Column | str, salt: str | Column) -> Column:
    """Uniform number in [0, 1): the first 52 bits of md5("key|salt")."""
    key = F.col(key) if isinstance(key, str) else key
    salt = F.lit(salt) if isinstance(salt, str) else salt
    digest = F.md5(F.concat_ws("|", key.cast("string"), salt.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def draws(keys: np.ndarray, salts: list[str]) -> np.ndarray:
    """``u`` of whole numbers for each salt (salts x keys), worked out for many keys at once; a masked key counts as null."""
    out = np.empty((len(salts), len(keys)))
    for low in range(0, len(keys), HASHED):
        part = keys[low:low + HASHED]
        numbers, nulls = np.ma.getdata(part).astype(np.int64), np.ma.getmaskarray(part)
        size = np.where(numbers < 0, (~numbers).view(np.uint64) + np.uint64(1), numbers.view(np.uint64))
        digits = 1 + sum((size >= np.uint64(10**p)).astype(int) for p in range(1, 19))
        for sign, count in {*zip((numbers < 0).tolist(), digits.tolist())}:
            own = np.flatnonzero((digits == count) & ((numbers < 0) == sign))
            rest, letters = size[own], np.empty((len(own), count + sign), np.uint8)
            for place in range(count + sign - 1, sign - 1, -1):
                tens = rest // np.uint64(10)
                letters[:, place] = rest - tens * np.uint64(10) + np.uint64(48)
                rest = tens
            if sign:
                letters[:, 0] = ord("-")
            for i, salt in enumerate(salts):
                out[i, low + own] = _md5_share(letters, f"|{salt}".encode())
        for i, salt in enumerate(salts if nulls.any() else ()):
            out[i, low:low + HASHED][nulls] = int(hashlib.md5(salt.encode()).hexdigest()[:13], 16) / float(1 << 52)
    return out


def _md5_share(letters: np.ndarray, rest: bytes) -> np.ndarray:
    """First 52 bits, as a share of one, of the MD5 of texts of equal length (rows of ``letters``, then ``rest``), 55 bytes at most."""
    n, size = letters.shape
    if size + len(rest) > 55:
        raise ValueError(f"{rest!r} is too long for one block")
    same = np.zeros(64, np.uint8)
    same[size:size + len(rest)] = np.frombuffer(rest, np.uint8)
    same[size + len(rest)], same[56:58] = 128, np.frombuffer(np.uint16(8 * (size + len(rest))).tobytes(), np.uint8)
    words: list = [int(w) for w in same.view("<u4")]
    wide = np.zeros((n, 4 * -(-size // 4)), np.uint8)
    wide[:, :size] = letters
    for i in range(wide.shape[1] // 4):
        words[i] = np.ascontiguousarray(wide[:, 4 * i:4 * i + 4]).view("<u4").ravel() | np.uint32(words[i])
    a, b, c, d = (np.full(n, start, np.uint32) for start in MD5_START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i, (turn, added) in enumerate(zip(MD5_TURNS, MD5_ADDED)):
        if i < 16:
            at = i
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            at = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            at = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            at = 7 * i % 16
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        if isinstance(words[at], int):
            np.add(f, np.uint32((words[at] + added) & 0xFFFFFFFF), out=f)
        else:
            np.add(f, words[at], out=f)
            np.add(f, np.uint32(added), out=f)
        np.right_shift(f, np.uint32(32 - turn), out=t)
        np.left_shift(f, np.uint32(turn), out=f)
        np.bitwise_or(f, t, out=f)
        np.add(f, b, out=a)
        a, b, c, d = d, a, b, c
    first, second = (a + np.uint32(MD5_START[0])).byteswap(), (b + np.uint32(MD5_START[1])).byteswap()
    return ((first.astype(np.uint64) << np.uint64(20)) | (second >> np.uint32(12))).astype(float) / float(1 << 52)


def gauss(key: Column, tag: str = "n") -> Column:
    """Standard normal draw from two uniform streams (Box-Muller)."""
    # 1 - u lies in (0, 1], so the logarithm is finite.
    radius = F.sqrt(-2.0 * F.log(1.0 - u(key, f"{tag}1")))
    return radius * F.cos(F.lit(2.0 * math.pi) * u(key, f"{tag}2"))


def pick_int(draw: Column, low: int, high: int, step: int = 1) -> Column:
    """Integer in low, low+step, .., high from a uniform draw."""
    return (F.lit(low) + F.floor(draw * ((high - low) // step + 1)) * step).cast("int")


def pick_float(draw: Column, low: float, high: float, log: bool = False) -> Column:
    """Number in [low, high) from a uniform draw, evenly spread on a linear or a logarithmic scale."""
    if log:
        return F.exp(F.lit(math.log(low)) + draw * (math.log(high) - math.log(low)))
    return F.lit(low) + draw * (high - low)


def pick_level(draw: Column, levels: list) -> Column:
    """One of the levels from a uniform draw."""
    return F.element_at(F.array(*[F.lit(v) for v in levels]), (F.floor(draw * len(levels)) + 1).cast("int"))
