import os
import random

import numpy as np
import pytest

from tablewire.functions.checksums import contribution, crc32c, crc32c_many


def bitwise(data):
    register = 0xFFFFFFFF
    for byte in data:
        register ^= byte
        for _ in range(8):
            register = (register >> 1) ^ (0x82F63B78 if register & 1 else 0)
    return register ^ 0xFFFFFFFF


def test_published_check_value():
    assert crc32c(b"123456789") == 0xE3069283


@pytest.mark.parametrize("size", [0, 1, 3, 4, 5, 255, 256, 257, 1023, 1024, 1025, 4097])
def test_sizes(size):
    data = os.urandom(size)
    assert crc32c(data) == bitwise(data)


def test_checksum_of_the_whole_from_its_parts():
    rng = random.Random(1)
    parts = [rng.randbytes(rng.randint(0, 900)) for _ in range(25)]
    whole = b"".join(parts)
    after = [len(whole) - sum(len(p) for p in parts[: i + 1]) for i in range(len(parts))]
    shares = contribution(crc32c_many(parts), np.array(after))
    assert int(np.bitwise_xor.reduce(shares)) == bitwise(whole)


def test_split_points_do_not_matter():
    data = os.urandom(300)
    for cut in (4, 8, 208, 244):
        shares = contribution(crc32c_many([data[:cut], data[cut:]]), np.array([300 - cut, 0]))
        assert int(shares[0] ^ shares[1]) == crc32c(data)
