"""Random draws as column expressions of a key.

A draw depends only on its key (seed, purpose, row or cell), never on the layout of the data, so a
task that is run again after a lost executor repeats its draws and any partitioning gives the same
result.
"""

from __future__ import annotations

import binascii
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# 13 hexadecimal digits: the largest integer range a double holds without loss.
DIGITS = 13
RANGE = float(16**DIGITS)


def key_of(*parts) -> Column:
    """Join literals and columns to one text key."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws("|", *[c.cast("string") for c in columns])


def _slice(digest: Column, index: int) -> Column:
    return F.conv(F.substring(digest, 1 + DIGITS * index, DIGITS), 16, 10).cast("double")


def uniform(key: Column, index: int = 0) -> Column:
    """A number in [0, 1); one key serves index 0 and 1 independently. For sampling, not for noise."""
    return _slice(F.md5(key), index) / F.lit(RANGE)


def uniform_pair(digests: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """``uniform`` of index 0 and 1 for a batch of MD5 digests in hexadecimal, without parsing each as text."""
    if not len(digests):
        return np.zeros(0), np.zeros(0)
    digests = digests.cast(pa.string())
    ends = np.frombuffer(digests.buffers()[1], "i4")[digests.offset : digests.offset + len(digests) + 1]
    raw = binascii.unhexlify(memoryview(digests.buffers()[2])[ends[0] : ends[-1]])
    high, low = np.frombuffer(raw, ">u8").reshape(len(digests), 2).astype("u8").T
    first, second = high >> np.uint64(12), ((high & np.uint64(0xFFF)) << np.uint64(40)) | (low >> np.uint64(24))
    return first.astype("f8") / RANGE, second.astype("f8") / RANGE


def gumbel(key: Column) -> Column:
    """A standard Gumbel number (cryptographic hash of the key)."""
    return -F.ln(-F.ln((_slice(F.sha2(key, 256), 0) + F.lit(0.5)) / F.lit(RANGE)))


def gaussian(key: Column) -> Column:
    """A standard normal number (Box-Muller on a cryptographic hash of the key)."""
    digest = F.sha2(key, 256)
    radius = F.sqrt(F.lit(-2.0) * F.ln((_slice(digest, 0) + F.lit(1.0)) / F.lit(RANGE + 1)))
    return radius * F.cos(F.lit(2.0 * math.pi) * (_slice(digest, 1) / F.lit(RANGE)))
