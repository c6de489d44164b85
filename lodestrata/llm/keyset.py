"""A bitmap of bounded size that answers "may this key be in the set?".

It only spares work: what passes is checked exactly afterwards. Its size is at most
``2 ** MAX_BITS`` bits (16 MB) whatever the data; beyond that more keys pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BITS = 27


class KeySet:
    """Membership test of well-mixed 64-bit keys, without false negatives."""

    def __init__(self, bits: int, words: np.ndarray):
        self.bits, self.words = bits, words

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def collect_keys(keys: DataFrame, column: str, rows: int | None = None) -> KeySet:
    """The bitmap of a long column. At most ``2 ** (MAX_BITS - 6)`` words reach the driver."""
    n = keys.count() if rows is None else rows
    bits = min(MAX_BITS, max(12, (n * 16).bit_length()))
    at = F.shiftrightunsigned(F.col(column), 64 - bits)
    slot = keys.select(at.alias("_at")).select(F.shiftright("_at", 6).alias("w"), F.expr("shiftleft(1L, CAST(_at & 63L AS INT))").alias("b"))
    table = slot.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    if table.num_rows:
        words[table.column("w").to_numpy()] = table.column("b").to_numpy().view(np.uint64)
    return KeySet(bits, words)
