"""Pieces shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a key filter per key, at least.
SPARSE = 32

#: Java and RE2 pattern of white space between words.
BLANK = r"[\x20\x09-\x0D]"
#: The characters of BLANK, for translate().
BLANKS = " \t\n\x0b\x0c\r"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    A lambda variable is the one construct that keeps the optimizer from
    inlining ``value`` at each of its uses inside higher-order functions.
    """
    return F.transform(F.array(value), body)[0]


def spaced(text: Column) -> Column:
    """The text with every blank character as a space; byte searches only."""
    for blank in BLANKS[1:]:
        text = F.replace(text, F.lit(blank), F.lit(" "))
    return text


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives an empty array."""
    return F.filter(F.split(spaced(F.coalesce(text, F.lit(""))), " "), lambda w: w != "")


@dataclass
class KeyFilter:
    """Which longs may be among the (hashed) keys of a table: a Bloom filter of
    two probes with SPARSE bits a key or more, so that at most one of 250 others
    passes. It is false where the table has more than ``most`` keys: then it
    isn't made, and callers join by the keys instead."""

    bits: int
    held: Broadcast | None

    @classmethod
    def of(cls, keys: DataFrame, name: str, most: int = 1 << 22) -> KeyFilter:
        number = keys.count()
        if number > most:
            return cls(0, None)
        bits = max(16, (number * SPARSE).bit_length())
        # The second probe takes the bits that the first leaves, turned around.
        turned = F.expr(f"shiftleft({name}, 32) | shiftrightunsigned({name}, 32)")
        probes = keys.select(F.explode(F.array(F.col(name), turned)).alias("k"))
        bit = F.expr(f"bit_or(shiftleft(1L, cast(shiftrightunsigned(k, {64 - bits}) & 63 as int)))")
        found = probes.groupBy(F.shiftrightunsigned("k", 64 - bits + 6).cast("int").alias("w")).agg(bit.alias("b")).toArrow()
        held = np.zeros(1 << (bits - 6), np.uint64)
        held[found["w"].to_numpy().astype(np.int64)] = found["b"].to_numpy().view(np.uint64)
        return cls(bits, keys.sparkSession.sparkContext.broadcast(held))

    def __bool__(self) -> bool:
        return self.held is not None

    def may_hold(self, keys: np.ndarray) -> np.ndarray:
        """For unsigned keys."""
        held, found = self.held.value, np.ones(len(keys), bool)
        for probe in (keys, (keys << np.uint64(32)) | (keys >> np.uint64(32))):
            slot = probe >> np.uint64(64 - self.bits)
            found &= (held[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
        return found
