"""Hashes used by the distinct-count sketches (SC-9, UV-2, UV-3).

All of them are built from SQL built-ins (``aggregate`` over the characters,
``ascii``, ``&``, ``%``) so they run JVM-side and can be reproduced in any SQL
engine for an exact oracle.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference: the polynomial string hash
# h = h * 61 + char, masked to a bitmap of 2^29 bits.
BITMAP_HASH_SEED = 61
BITMAP_BITS_LOG2 = 29

# Hash family for the Bloom positions, quadratic so that runs of similar ids
# (consecutive numbers) do not land on a lattice of bit positions:
#   h_i(x) = ((a_i * x^2 + b_i * x + a_i) mod P) mod m,  P = 2^31 - 1,
# with a_i / b_i generated by a rule below.  Every product stays below 2^62.
MERSENNE_31 = (1 << 31) - 1


def poly_hash(c, seed: int = BITMAP_HASH_SEED, bits: int = BITMAP_BITS_LOG2) -> Column:
    """``h = (h * seed + code(char)) & (2^bits - 1)`` over the text of ``c``.

    Masking every step equals masking once because 2^bits is a power of two,
    and it keeps the running value small enough that ANSI long arithmetic can
    never overflow.
    """
    c = F.col(c) if isinstance(c, str) else c
    mask = (1 << bits) - 1
    chars = F.split(c.cast("string"), "")
    return F.aggregate(chars, F.lit(0).cast("long"),
                       lambda acc, ch: (acc * seed + F.ascii(ch)).bitwiseAND(F.lit(mask)))


def bloom_size(expected_insertions: int, fpp: float) -> tuple[int, int]:
    """Standard optimal Bloom sizing: m = -n ln p / (ln 2)^2, k = round(m/n ln 2)."""
    m = int(-expected_insertions * math.log(fpp) / (math.log(2) ** 2))
    k = max(1, int(round(m / expected_insertions * math.log(2))))
    return m, k


def bloom_coefficients(k: int) -> list[tuple[int, int]]:
    """(a_i, b_i) for i < k: powers of the minimal-standard multiplier 48271
    modulo 2^31-1, and b_i = 7919 * (i + 1)."""
    out, a = [], 1
    for i in range(k):
        a = (a * 48271) % MERSENNE_31
        out.append((a, 7919 * (i + 1)))
    return out


def bloom_positions(c, m: int, k: int) -> Column:
    """Array of the k bit positions of ``c`` in an m-bit Bloom filter."""
    x = poly_hash(c, seed=BITMAP_HASH_SEED, bits=31)
    x2 = (x * x) % MERSENNE_31
    return F.array(*[((((x2 * a) % MERSENNE_31) + ((x * b) % MERSENNE_31) + a) % MERSENNE_31) % m
                     for a, b in bloom_coefficients(k)])


def bloom_estimate(bits_set: Column, m: int, k: int) -> Column:
    """Cardinality from the number X of set bits: n = -(m/k) ln(1 - X/m).  A
    filter without a free bit says nothing; that raises an error."""
    full = F.raise_error(F.lit(f"Bloom filter of {m} bits is full: size it for more visitors"))
    return F.when(bits_set >= m, full.cast("long")).otherwise(_bloom_inverse(bits_set, m, k))


def _bloom_inverse(bits_set: Column, m: int, k: int) -> Column:
    return F.round(-(F.lit(m) / k) * F.log(1 - bits_set / F.lit(m))).cast("long")
