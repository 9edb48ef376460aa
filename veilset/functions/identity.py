"""Synthetic identities as pure functions of a key (S12 generator).

Every field is derived from ``sha2(seed:tag:key)``, so one key always gets
the same person, in every table and every run, without a lookup table of
its own.  All expressions are built-in functions; the card numbers carry a
valid Luhn check digit (an unrolled sum of digits).

Numbers that must differ from person to person (cards, national id, bank
account) are the key itself under format-preserving encryption (``fpe``), not a
hash: whole-number keys below ``10 ** n`` never share an ``n``-digit number, and
known pairs do not give away others.  Other keys (text, or numbers beyond that)
get hashed digits, which may repeat, unless a dense number stands in for them
(``operators.dense``).

The seed is a secret without a default: whoever knows it can compute a key's
identity.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fpe

# invented name and place lists for synthetic people
FIRST_NAMES = ["Ada", "Ben", "Cleo", "Dan", "Eva", "Finn", "Gus", "Hana", "Ivo", "Jade",
               "Kai", "Lena", "Milo", "Nora", "Otto", "Pia", "Quin", "Rosa", "Sven", "Tara",
               "Uma", "Vito", "Wren", "Yara"]
LAST_NAMES = ["Abbot", "Brook", "Carver", "Dale", "Ember", "Frost", "Glen", "Hart",
              "Irving", "Jarvis", "Kemp", "Lowe", "Marsh", "North", "Oakes", "Pike",
              "Quarry", "Reed", "Stone", "Thorne", "Underhill", "Vale", "West", "Yates"]
MIDDLE_INITIALS = list(string.ascii_uppercase)
EMPLOYERS = ["Acme Works", "Blue Harbor", "Cedar Labs", "Delta Freight", "Evergreen Foods",
             "Fjord Systems", "Granite Bank", "Helix Media", "Iron Gate", "Juniper Health"]
STREETS = ["Maple St", "Oak Ave", "Pine Rd", "Cedar Ln", "Elm Ct", "Birch Way", "Willow Dr",
           "Aspen Pl", "Spruce Blvd", "Hazel Row", "Linden Sq", "Poplar Pkwy"]
CITIES = ["Springfield", "Riverton", "Lakeside", "Fairview", "Georgetown", "Ashford",
          "Brookvale", "Clearwater", "Dunmore", "Eastwood", "Franklin", "Greenville"]
STATES = ["AL", "AZ", "CA", "CO", "FL", "GA", "IL", "MA", "NY", "OH", "TX", "WA"]
COUNTRY = "US"

FIELDS = ("id", "cm15", "cm13", "cm11", "cust_id", "first_nm", "mid_nm", "lst_nm", "cm_dob",
          "nat_id", "incom_self", "asset_am", "bank_acct_no", "emplr_nm", "addr_line1",
          "addr_line2", "addr_line3", "addr_line4", "addr_line5", "city", "state", "zip_code",
          "country", "email", "phone")
NUMBERS = frozenset(("cm15", "cm13", "cm11", "nat_id", "bank_acct_no"))    # encrypted keys


def digest(key: Column, tag: str, seed: str) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(seed), F.lit(tag), key.cast("string")), 256)


def uniform(key: Column, tag: str, n: int, seed: str) -> Column:
    """An integer in [0, n) from the first 32 bits of the digest."""
    return F.conv(F.substring(digest(key, tag, seed), 1, 8), 16, 10).cast("bigint") % F.lit(n)


def pick(key: Column, tag: str, values: list[str], seed: str) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (uniform(key, tag, len(values), seed) + 1).cast("int"))


def digits(key: Column, tag: str, n: int, seed: str) -> Column:
    """``n`` decimal digits, in chunks of at most 8 per digest."""
    parts, i = [], 0
    while n > 0:
        size = min(8, n)
        parts.append(F.lpad(uniform(key, f"{tag}{i}", 10 ** size, seed).cast("string"),
                            size, "0"))
        n -= size
        i += 1
    return F.concat(*parts)


def unique_digits(key: Column, tag: str, n: int, seed: str,
                  number: Column | None = None) -> Column:
    """``n`` decimal digits (at most 18), different for different whole-number keys
    from 0 to ``10 ** n - 1`` (for ``number`` in place of the key, if given)."""
    m = 10 ** n
    k = number if number is not None else key.cast("string").try_cast("bigint")
    inside = (k >= 0) & (k < m)
    if number is None:          # '007' is not the key 7
        inside = inside & (k.cast("string") == key.cast("string"))
    made = fpe.encrypt_number(F.when(inside, k), m, seed, tag)
    return F.when(inside, F.lpad(made.cast("string"), n, "0")).otherwise(
        digits(key, tag, n, seed))


def luhn_complete(payload: Column, n: int) -> Column:
    """``payload`` (``n`` digits) followed by their Luhn check digit."""
    def completed(p: Column) -> Column:
        total = F.lit(0)
        for i in range(n):
            d = F.substring(p, n - i, 1).cast("int")
            total = total + (d if i % 2 else F.when(d > 4, d * 2 - 9).otherwise(d * 2))
        return F.concat(p, ((10 - total % 10) % 10).cast("string"))

    # bound to a variable: the payload is computed once, not once per digit
    return F.element_at(F.transform(F.array(payload), completed), 1)


def luhn_valid(number: Column) -> Column:
    """True when the digit string passes the Luhn check."""
    rev = F.reverse(F.split(number, ""))
    weighted = F.transform(rev, lambda d, i: F.when(
        i % 2 == 1, F.when(d.cast("int") * 2 > 9, d.cast("int") * 2 - 9)
        .otherwise(d.cast("int") * 2)).otherwise(d.cast("int")))
    return F.aggregate(weighted, F.lit(0), lambda acc, x: acc + x) % 10 == 0


def field(name: str, key: Column, seed: str, number: Column | None = None) -> Column:
    """One identity field for ``key``; ``number`` (dense, one per key) makes the
    unique numbers in place of the key."""
    s = seed
    if name == "id":
        return F.conv(F.substring(digest(key, "id", s), 1, 15), 16, 10).cast("bigint")
    if name == "cust_id":
        return key
    if name == "cm15":
        return luhn_complete(F.concat(F.lit("37"), unique_digits(key, "cm15_", 12, s, number)), 14)
    if name == "cm13":
        return luhn_complete(F.concat(F.lit("4"), unique_digits(key, "cm13_", 11, s, number)), 12)
    if name == "cm11":
        return luhn_complete(F.concat(F.lit("6"), unique_digits(key, "cm11_", 9, s, number)), 10)
    if name == "first_nm":
        return pick(key, "first", FIRST_NAMES, s)
    if name == "mid_nm":
        return pick(key, "mid", MIDDLE_INITIALS, s)
    if name == "lst_nm":
        return pick(key, "last", LAST_NAMES, s)
    if name == "cm_dob":
        return F.date_add(F.lit("1940-01-01").cast("date"), uniform(key, "dob", 22000, s).cast("int"))
    if name == "nat_id":
        return F.concat(F.lit("9"), unique_digits(key, "nid_", 8, s, number))
    if name == "incom_self":
        return (uniform(key, "income", 180000, s) + 20000).cast("double")
    if name == "asset_am":
        return uniform(key, "asset", 5000000, s).cast("double")
    if name == "bank_acct_no":
        return unique_digits(key, "bank_", 10, s, number)
    if name == "emplr_nm":
        return pick(key, "employer", EMPLOYERS, s)
    if name == "addr_line1":
        return F.concat_ws(" ", (uniform(key, "house", 9900, s) + 100).cast("string"),
                           pick(key, "street", STREETS, s))
    if name == "addr_line2":
        return F.concat(F.lit("Apt "), (uniform(key, "apt", 900, s) + 1).cast("string"))
    if name == "addr_line3":
        return F.concat(F.lit("Bldg "), (uniform(key, "bldg", 50, s) + 1).cast("string"))
    if name == "addr_line4":
        return F.concat(F.lit("Floor "), (uniform(key, "floor", 40, s) + 1).cast("string"))
    if name == "addr_line5":
        return F.concat(F.lit("PO Box "), (uniform(key, "box", 9000, s) + 1000).cast("string"))
    if name == "city":
        return pick(key, "city", CITIES, s)
    if name == "state":
        return pick(key, "state", STATES, s)
    if name == "zip_code":
        return digits(key, "zip_", 5, s)
    if name == "country":
        return F.lit(COUNTRY)
    if name == "email":
        return F.lower(F.concat(pick(key, "first", FIRST_NAMES, s), F.lit("."),
                                pick(key, "last", LAST_NAMES, s), F.lit("."),
                                digits(key, "mail_", 4, s), F.lit("@example.test")))
    if name == "phone":
        return F.concat(F.lit("555"), digits(key, "phone_", 7, s))
    raise KeyError(f"unknown identity field {name!r}")


def identity_columns(key: Column, fields, seed: str,
                     number: Column | None = None) -> list[Column]:
    return [field(f, key, seed, number).alias(f) for f in fields]


class IdentityGenerator:
    """Identities computed from the driver key by expressions, no table.

    Passed where an identity table is expected, it lets the scrub skip the
    identity join: every key has exactly one identity (so ``inner`` and
    ``left`` agree), and the fields are derived next to the row that needs
    them."""

    def __init__(self, seed: str):
        if not seed:
            raise ValueError("identities need a secret seed")
        self.seed = seed

    def field(self, name: str, key: Column) -> Column:
        return field(name, key, self.seed)

    def table(self, keys, key_col: str, fields=FIELDS):
        """The same identities as a table (one row per distinct key)."""
        k = keys.select(F.col(key_col).alias("__k")).dropna().distinct()
        return k.select(*identity_columns(F.col("__k"), fields, self.seed))
