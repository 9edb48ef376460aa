"""Format-preserving encryption of numbers as built-in expressions.

A Feistel network over two halves of a number: in turn one half is added to a
keyed function of the other, modulo its size, so whatever the function is, the
whole is a permutation of the domain and can be undone with the secret.  The
function is HMAC-SHA-256 of (tweak, round, half).  For a domain of ``10 ** n`` the
halves are decimal digits; another domain is split into two sizes whose product is
just beyond it, and a result outside is encrypted again until it falls inside
(cycle walking), which keeps the permutation.

Known pairs tell nothing about other numbers: there is no linear relation to
solve, as there is for a multiply-and-add permutation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .crypto import hmac_pads

ROUNDS = 10
_WALK = 64          # turns of cycle walking; each leaves the domain with chance < 1/3


def halves(size: int) -> tuple[int, int]:
    """Sizes of the two halves; their product is ``size`` or just beyond it."""
    if not 2 <= size <= 10 ** 18:
        raise ValueError("a domain holds 2 to 10 ** 18 numbers")
    n = len(str(size)) - 1
    if size == 10 ** n and n > 1:
        return 10 ** (n - n // 2), 10 ** (n // 2)
    a = math.isqrt(size - 1) + 1
    return a, -(-size // a)


def _mixed(secret: str, tweak: str, turn: Column, half: Column, size: Column) -> Column:
    """A number below ``size`` from HMAC-SHA-256 of (tweak, round, half)."""
    inner, outer = hmac_pads(secret)
    text = F.concat(F.lit(f"{tweak}:"), turn.cast("string"), F.lit(":"), half.cast("string"))
    first = F.sha2(F.concat(F.lit(bytearray(inner)), text.cast("binary")), 256)
    mac = F.sha2(F.concat(F.lit(bytearray(outer)), F.unhex(first)), 256)
    return F.conv(F.substring(mac, 1, 15), 16, 10).cast("bigint") % size


def _network(number: Column, size: int, secret: str, tweak: str, back: bool) -> Column:
    a, b = halves(size)
    turns = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    start = F.struct(F.call_function("div", number, F.lit(b)).cast("bigint").alias("l"),
                     (number % F.lit(b)).cast("bigint").alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        left = i % 2 == 0                                   # the half that changes
        size_ = F.when(left, F.lit(a)).otherwise(F.lit(b)).cast("bigint")
        mixed = _mixed(secret, tweak, i, F.when(left, acc["r"]).otherwise(acc["l"]), size_)
        now = F.when(left, acc["l"]).otherwise(acc["r"])
        now = F.pmod(now - mixed if back else now + mixed, size_)
        return F.struct(F.when(left, now).otherwise(acc["l"]).alias("l"),
                        F.when(left, acc["r"]).otherwise(now).alias("r"))

    return F.aggregate(F.array(*[F.lit(i) for i in turns]), start, turn,
                       lambda acc: acc["l"] * F.lit(b).cast("bigint") + acc["r"])


def _walked(number: Column, size: int, secret: str, tweak: str, back: bool) -> Column:
    number = number.cast("bigint")
    outside = F.raise_error(F.concat(F.lit(f"not a number below {size}: "),
                                     number.cast("string"))).cast("bigint")
    number = F.when(number.isNull() | ((number >= 0) & (number < size)), number) \
        .otherwise(outside)
    out = _network(number, size, secret, tweak, back)
    a, b = halves(size)
    if a * b > size:
        out = F.aggregate(F.sequence(F.lit(1), F.lit(_WALK)), out, lambda x, _: F.when(
            x < size, x).otherwise(_network(x, size, secret, tweak, back)))
    return out


def encrypt_number(number: Column, size: int, secret: str, tweak: str = "") -> Column:
    """Another number below ``size`` for each number from 0 below ``size`` (bigint);
    NULL stays NULL, a number outside is an error."""
    return _walked(number, size, secret, tweak, False)


def decrypt_number(number: Column, size: int, secret: str, tweak: str = "") -> Column:
    """Inverse of :func:`encrypt_number`."""
    return _walked(number, size, secret, tweak, True)
