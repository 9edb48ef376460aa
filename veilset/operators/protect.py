"""Extract-side protection.

The extract projection replaces PII by typed NULLs *as an expression over
the scan*: Catalyst then drops those columns from the scan's ReadSchema (and
from the JDBC query), so the values never leave the source.  Encryption is
``withColumns`` over the projected rows, so column order is kept.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import ColumnMeta, TableMeta
from ..functions import crypto

BINARY_KINDS = ("bytea", "blob", "raw", "binary")
BINARY_TEXT_CHARS = 1000          # declared target: VARCHAR(1000)


def binary_text(col: Column, max_chars: int | None = None) -> Column:
    """Binary -> text (UTF-8), the whole value.

    The target type is a VARCHAR(1000); values longer than that are not cut
    (a silent prefix loses data) but reported by ``validate.validate_rows``
    (check ``max_length``) against the declared length, 1000 if none is.  ``max_chars`` cuts explicitly when a caller
    wants the bounded column instead."""
    text = col.cast("string")
    return text if max_chars is None else F.substring(text, 1, max_chars)


def kept_pii(meta: TableMeta) -> set[str]:
    """PII columns exempt from nulling: primary keys, the driver column,
    and the column carrying the highest-priority rule present."""
    winner = meta.highest_priority_rule()
    drv = {c.strip().lower() for c in (meta.driver_column or "").split(",") if c.strip()}
    out = set()
    for c in meta.columns:
        if not c.is_pii:
            continue
        rule_wins = winner is not None and (
            c.rule == winner or (winner == "cust_id" and c.rule is None
                                 and c.name.lower() == "cust_id"))
        if c.is_pk or c.name.lower() in drv or rule_wins:
            out.add(c.name)
    return out


def extract_projection(df: DataFrame, meta: TableMeta,
                       columns: Sequence[str] | None = None) -> DataFrame:
    """P1 + P2 + P3 + P4: the column list of an extract.

    PII not exempt -> ``NULL`` of the column's type; binary -> text."""
    keep = kept_pii(meta)
    out = []
    for name in columns or meta.names:
        cm = meta.column(name)
        dtype = df.schema[name].dataType
        if cm.is_pii and name not in keep:
            out.append(F.lit(None).cast(dtype).alias(name))
        elif cm.kind in BINARY_KINDS:
            out.append(binary_text(F.col(name)).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def project_columns(df: DataFrame, meta: TableMeta) -> DataFrame:
    """The declared column list, in declared order."""
    return df.select(*meta.names)


def null_default(df: DataFrame, value: str = "NA",
                 columns: Sequence[str] | None = None) -> DataFrame:
    """Empty string columns get a default."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.na.fill(value, subset=list(cols))


# ---------------------------------------------------------------------------
# E1-E5

def encrypted_key_columns(meta: TableMeta) -> list[str]:
    """PII columns encrypted with the environment key on the way out: all that
    the extract keeps (primary keys, the driver column, the column of the
    highest-priority rule), unless one-way hashed."""
    kept = kept_pii(meta)
    return [c.name for c in meta.columns if c.name in kept and not c.is_key_hash]


def encrypt_columns(df: DataFrame, columns: Sequence[str], key: bytes | str,
                    mode: str = "GCM") -> DataFrame:
    """E1 + P7: replace columns by their ciphertext, order kept."""
    if not columns:
        return df
    return df.withColumns({c: crypto.encrypt(F.col(c), key, mode) for c in columns})


def decrypt_columns(df: DataFrame, columns: Sequence[str], key: bytes | str,
                    types: Mapping[str, T.DataType | str] | None = None,
                    mode: str = "GCM") -> DataFrame:
    """Replace ciphertext columns by their values (``types`` restores the
    original column types)."""
    if not columns:
        return df
    types = types or {}
    return df.withColumns({
        c: crypto.decrypt(F.col(c), key, mode, dtype=types.get(c, "string")) for c in columns})


def _column_key(cm: ColumnMeta, keys: Mapping[str, bytes | str]) -> bytes | str:
    if not cm.key_name or cm.key_name not in keys:
        raise KeyError(f"no key {cm.key_name!r} for column {cm.name}")
    return keys[cm.key_name]


def column_key_mode(cm: ColumnMeta) -> str:
    """Random IV (GCM) unless the column is stored without one (ECB)."""
    return "GCM" if cm.use_iv else "ECB"


def db_encrypted_columns(meta: TableMeta, names: Sequence[str] | None = None) -> list[ColumnMeta]:
    """Columns the source stores encrypted with their own key."""
    cols = [meta.column(n) for n in names] if names else list(meta.columns)
    return [c for c in cols if c.is_encrypted
            and (c.rule == "primary_pan_acct_nbr15" or c.is_pk)]


def decrypt_with_column_keys(df: DataFrame, meta: TableMeta,
                             keys: Mapping[str, bytes | str],
                             types: Mapping[str, T.DataType | str] | None = None,
                             columns: Sequence[str] | None = None) -> DataFrame:
    """Decrypt source-encrypted columns, each with its own key and mode.
    One-way hashed columns (E6) pass through unchanged."""
    types = types or {}
    repl = {}
    for cm in db_encrypted_columns(meta, columns):
        if cm.name not in df.columns or cm.is_key_hash:
            continue
        repl[cm.name] = crypto.decrypt(F.col(cm.name), _column_key(cm, keys),
                                       column_key_mode(cm), dtype=types.get(cm.name, "string"))
    return df.withColumns(repl) if repl else df


def encrypt_with_column_keys(df: DataFrame, meta: TableMeta, keys: Mapping[str, bytes | str],
                             columns: Sequence[str]) -> DataFrame:
    """Encrypt columns with their own keys (the source's encryption)."""
    repl = {}
    for name in columns:
        cm = meta.column(name)
        if cm.is_key_hash:
            continue
        repl[name] = crypto.encrypt(F.col(name), _column_key(cm, keys), column_key_mode(cm))
    return df.withColumns(repl) if repl else df


def prepare_keys(keys: DataFrame, meta: TableMeta, key_columns: Sequence[str], *,
                 env_key: bytes | str, column_keys: Mapping[str, bytes | str] | None = None,
                 driver_meta: TableMeta | None = None) -> DataFrame:
    """E5: driver keys as the source stores them.

    keys not encrypted -> as they are; applied -> decrypt with the environment
    key; applied and the source column encrypted -> decrypt, then encrypt
    with the column's own key so they compare equal to the source values.
    """
    if not meta.keys_encrypted:
        return keys
    plain = decrypt_columns(keys, key_columns, env_key)
    if meta.driver_column_encrypted:
        dm = driver_meta or meta
        drv_cols = [c.strip() for c in meta.driver_column.split(",")]
        mapping = dict(zip(key_columns, drv_cols))
        renamed = plain.withColumnsRenamed(mapping)
        enc = encrypt_with_column_keys(renamed, dm, column_keys or {}, drv_cols)
        return enc.withColumnsRenamed({v: k for k, v in mapping.items()})
    return plain
