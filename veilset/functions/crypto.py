"""Encryption and keyed hashing as built-in expressions.

``aes_encrypt`` / ``aes_decrypt`` run inside whole-stage codegen; no jar and
no Python UDF.  Modes:

* ``GCM`` (default): random IV per value, authenticated; the same input gives
  a different ciphertext every time, so ciphertexts cannot be joined.
* ``ECB``: deterministic (same input, same output), joinable, but equal
  blocks show; only for per-column keys of sources that store it so.

A joinable token that does not reveal equal blocks is a keyed hash
(HMAC-SHA-256), kept beside a GCM ciphertext when needed.
Keys are parameters (bytes or str of 16/24/32 bytes), never config values.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MODES = ("GCM", "ECB", "CBC")


def _key(key: bytes | str) -> Column:
    if isinstance(key, str):
        key = key.encode("utf-8")
    if len(key) not in (16, 24, 32):
        raise ValueError("AES keys are 16, 24 or 32 bytes")
    return F.lit(bytearray(key))


def _mode(mode: str) -> str:
    m = mode.upper()
    if m not in MODES:
        raise ValueError(f"unknown AES mode {mode!r}")
    return m


def encrypt(col: Column, key: bytes | str, mode: str = "GCM", *, iv: bytes | None = None,
            aad: str | None = None) -> Column:
    """Value (as text) -> base64 ciphertext."""
    m = _mode(mode)
    args = [col.cast("string"), _key(key), F.lit(m), F.lit("DEFAULT")]
    if iv is not None or aad is not None:
        args.append(F.lit(bytearray(iv)) if iv is not None else F.lit(bytearray()))
    if aad is not None:
        args.append(F.lit(aad))
    return F.base64(F.aes_encrypt(*args))


def decrypt(col: Column, key: bytes | str, mode: str = "GCM", *,
            dtype: T.DataType | str = "string", aad: str | None = None) -> Column:
    """base64 ciphertext -> value of ``dtype``.  A wrong key or a damaged value
    raises (a failed decrypt never looks like data)."""
    m = _mode(mode)
    args = [F.unbase64(col), _key(key), F.lit(m), F.lit("DEFAULT")]
    if aad is not None:
        args.append(F.lit(aad))
    out = F.aes_decrypt(*args).cast("string")
    return out if dtype in ("string", T.StringType()) else out.cast(dtype)


def keyed_hash(col: Column, secret: str) -> Column:
    """One-way, joinable token: equal inputs give equal tokens.

    HMAC-SHA-256 (RFC 2104), hex: unlike a hash of secret and value run
    together, no token can be extended, and no secret and value can be cut
    differently to give the same token."""
    inner, outer = hmac_pads(secret)
    message = F.concat(F.lit(bytearray(inner)), col.cast("string").cast("binary"))
    return F.sha2(F.concat(F.lit(bytearray(outer)), F.unhex(F.sha2(message, 256))), 256)


def hmac_pads(secret: str) -> tuple[bytes, bytes]:
    """The secret as HMAC's inner and outer block."""
    key = secret.encode("utf-8")
    key = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)
