"""Deterministic pseudo-random draws from md5, identical in Spark and DuckDB.

``hash_unit(key, seed)`` maps a key to [0, 1) using the first 32 bits of
md5(key || '|' || seed). The same formula in DuckDB is
``('0x' || substr(md5(k), 1, 8))::BIGINT / 4294967296.0``. Spark's ``rand``,
``xxhash64`` and ``randomSplit`` depend on partitioning or have no DuckDB twin,
so splits, folds and bootstrap weights all go through this function instead.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _key(key: Column | str | list, seed) -> Column:
    cols = key if isinstance(key, list) else [key]
    parts = [F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]
    return F.concat_ws("|", *parts, F.lit(str(seed)))


def hash_unit(key, seed) -> Column:
    """Uniform double in [0, 1) derived from md5 of the key and the seed."""
    h = F.conv(F.substring(F.md5(_key(key, seed)), 1, 8), 16, 10).cast("bigint")
    return h.cast("double") / F.lit(4294967296.0)


def hash_bucket(key, seed, k: int) -> Column:
    """Integer bucket 0..k-1 (uniform in expectation)."""
    return F.floor(hash_unit(key, seed) * k).cast("int")


# RFC 1321: the 64 constants, the rotations and which word of the message each step adds.
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2 ** 32)) for i in range(64)]
_TURNS = [7, 12, 17, 22] * 4 + [5, 9, 14, 20] * 4 + [4, 11, 16, 23] * 4 + [6, 10, 15, 21] * 4
_ORDER = [*range(16), *[(5 * i + 1) % 16 for i in range(16)], *[(3 * i + 5) % 16 for i in range(16)], *[7 * i % 16 for i in range(16)]]
_START = [np.uint32(v) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
_ONE_BLOCK, _DIGESTS_AT_ONCE = 55, 1 << 14         # bytes of a message of one block; digests whose words stay in the processor's cache


def md5_words(keys: list[bytes], tails: list[bytes]) -> np.ndarray:
    """The four 32-bit words of md5(key + tail) as an array (4, tails, keys).

    Many digests at a time, as array arithmetic over messages of one block (about a fifth of the time of one hashlib call per
    digest); longer messages go to hashlib."""
    out, longest = np.empty((4, len(tails), len(keys)), np.uint32), max(map(len, tails))
    size = np.fromiter(map(len, keys), np.int64, len(keys))
    short = np.flatnonzero(size + longest <= _ONE_BLOCK)
    for i in np.flatnonzero(size + longest > _ONE_BLOCK).tolist():
        digests = b"".join([hashlib.md5(keys[i] + t).digest() for t in tails])
        out[:, :, i] = np.frombuffer(digests, ">u4").reshape(-1, 4).T
    if not len(short):
        return out
    size = size[short]
    words = np.frombuffer(b"".join([keys[i].ljust(64, b"\0") for i in short.tolist()]), "<u4").reshape(-1, 16).T
    lengths = [(int(n), np.flatnonzero(size == n)) for n in np.unique(size)]
    used = [*range((int(size.max()) + longest) // 4 + 1), 14]
    step = max(1, _DIGESTS_AT_ONCE // len(short))
    for a in range(0, len(tails), step):
        some = tails[a:a + step]
        message = {w: np.repeat(words[w][None], len(some), axis=0) for w in used}
        for n, at in lengths:                      # tail, end mark and length of the message behind the key
            ends = b"".join([(b"\0" * n + t + b"\x80").ljust(56, b"\0") + (8 * (n + len(t))).to_bytes(8, "little") for t in some])
            ends = np.frombuffer(ends, "<u4").reshape(-1, 16)
            for w in used:
                if ends[:, w].any():
                    message[w][:, at] |= ends[:, w][:, None]
        out[:, a:a + step, short] = _md5_of_blocks(message, (len(some), len(short)))
    return out


def _md5_of_blocks(message: dict, shape: tuple) -> np.ndarray:
    a, b, c, d = (np.full(shape, v) for v in _START)
    f, g = np.empty(shape, np.uint32), np.empty(shape, np.uint32)
    for i in range(64):
        if i < 16:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
        elif i < 32:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
        elif i < 48:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
        else:
            np.invert(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
        np.add(f, a, out=f)
        np.add(f, _SINES[i], out=f)
        if _ORDER[i] in message:                   # words that no message reaches are 0
            np.add(f, message[_ORDER[i]], out=f)
        np.left_shift(f, np.uint32(_TURNS[i]), out=g)
        np.right_shift(f, np.uint32(32 - _TURNS[i]), out=f)
        np.bitwise_or(f, g, out=f)
        np.add(f, b, out=f)
        a, b, c, d, f = d, f, b, c, a
    return np.stack([x + s for x, s in zip((a, b, c, d), _START)]).byteswap()


# Poisson(1) cumulative probabilities P(X <= k), k = 0..12; computed from the
# closed form, not stored. P(X > 12) < 1e-10, absorbed by the last step.
POISSON1_CDF = [sum(math.exp(-1.0) / math.factorial(i) for i in range(k + 1)) for k in range(13)]


def poisson1(u: Column) -> Column:
    """Poisson(1) draw by inverse CDF of a uniform ``u`` (a step function of u).

    Pass ``u`` as a column reference, not an expression: each branch re-evaluates it."""
    expr = F.lit(len(POISSON1_CDF))
    for k in reversed(range(len(POISSON1_CDF))):
        expr = F.when(u < F.lit(POISSON1_CDF[k]), F.lit(k)).otherwise(expr)
    return expr.cast("int")


def hash_order(key, seed) -> Column:
    """60-bit integer from md5(key || seed): a near-unique sort key (DuckDB:
    ``('0x' || substr(md5(k), 1, 15))::BIGINT``)."""
    return F.conv(F.substring(F.md5(_key(key, seed)), 1, 15), 16, 10).cast("bigint")
