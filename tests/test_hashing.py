"""Digests computed as arrays against hashlib, one by one."""

import hashlib

import numpy as np
import pytest

from sparkwright.functions.hashing import POISSON1_CDF, md5_words
from sparkwright.operators import evaluate as V


def test_md5_words_are_hashlibs():
    rng = np.random.default_rng(5)
    keys = [b"", "é|ü".encode(), b"\x00\xff", *[b"x" * n for n in (1, 3, 4, 46, 47, 48, 49, 54, 55, 56, 64, 200)],
            *[bytes(rng.integers(0, 256, rng.integers(0, 60), dtype=np.uint8)) for _ in range(300)]]
    for tails in ([b""], [b"|7|42"], [f"|{b}|42".encode() for b in range(125)]):
        got = md5_words(keys, tails)
        assert got.shape == (4, len(tails), len(keys))
        for j, tail in enumerate(tails):
            for i, key in enumerate(keys):
                assert got[:, j, i].tolist() == np.frombuffer(hashlib.md5(key + tail).digest(), ">u4").tolist()


@pytest.mark.parametrize("replicates", [1, 4, 7, 500])
def test_weights_come_from_the_words_of_the_digest(replicates):
    keys = ["1|2|3|4", "", "k" * 70, *map(str, range(2000))]
    got = V._weights(keys, replicates, 42)
    assert got.shape == (len(keys), replicates)
    for i in (0, 1, 2, 5, 2002):
        for r in range(1, replicates + 1):
            word = int.from_bytes(hashlib.md5(f"{keys[i]}|{(r - 1) // 4}|42".encode()).digest()[(r - 1) % 4 * 4:][:4], "big")
            assert got[i, r - 1] == sum(word >= p * 2 ** 32 for p in POISSON1_CDF)
    one = np.concatenate([V._weights([k], replicates, 42) for k in keys[:20]])
    assert (one == got[:20]).all()
