"""Extract job (reference lifecycle 3.1) as one lazy plan:
scan -> semi joins over the hops -> request filter -> typed NULLs for PII ->
order / limit -> encryption of key columns -> counted write."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..catalog import TableMeta
from ..operators import audit, protect, reconcile, subset
from ..session import remove_path
from ..sinks.files import write_files


def extract_plan(tables: Mapping[str, DataFrame], meta: TableMeta, *,
                 driver_keys: DataFrame | None = None,
                 driver_filter: Column | None = None,
                 primary_keys: Mapping[str, Sequence[str]] | None = None,
                 strategy: str = "join") -> DataFrame:
    """The rows and columns an extract writes (lazy; a single pass over the
    source when executed).  ``strategy``: how the driver keys meet their table
    (see ``subset.semi_join``)."""
    if meta.relational or meta.extract_type == "R" or driver_keys is not None:
        if meta.edges or meta.is_own_driver:
            rows = subset.extract_related(tables, meta, driver_keys=driver_keys,
                                          driver_filter=driver_filter,
                                          primary_keys=primary_keys, strategy=strategy)
        else:
            raise ValueError(f"{meta.table_name}: relational extract without relationship")
    else:
        rows = subset.extract_rows(tables[meta.table_name.lower()], meta)
    # order and limit see the source's values, not the NULLs put in their place
    if meta.limit is not None or meta.order:
        rows = subset.apply_order_limit(rows, meta)
    return protect.extract_projection(rows, meta)


def run_extract(spark: SparkSession, tables: Mapping[str, DataFrame], meta: TableMeta,
                out_path: str, *, fmt: str = "csv", env_key: bytes | str | None = None,
                driver_keys: DataFrame | None = None, driver_filter: Column | None = None,
                key_base: str | None = None,
                primary_keys: Mapping[str, Sequence[str]] | None = None,
                encrypt: bool = True, column_keys: Mapping[str, bytes] | None = None,
                audit_path: str | None = None, strategy: str = "join",
                remove_empty: bool = False) -> DataFrame:
    """Write the extract (and, for a relational extract, its key tables);
    return the job's audit record.

    Columns that the source stores encrypted with a key of their own are
    decrypted with ``column_keys`` first (a key that is missing is an error).  PII
    that stays in the extract (keys) is encrypted with ``env_key``; such columns
    without a key are an error unless the caller says ``encrypt=False``.
    ``driver_keys`` of a request whose keys arrive encrypted are made ready with
    ``env_key`` and ``column_keys``; ``strategy`` says how they meet the driver
    table (``join``, ``isin`` or ``runs``, see ``subset.semi_join``).  With
    ``audit_path`` the record is appended there, also when the job fails.

    An empty extract records 0 rows and encrypts nothing.  A shuffle-free one is
    probed and not written at all; another is written in one pass, and leaves a
    folder without rows, or none with ``remove_empty`` (see ``audit.gated_write``).
    Key tables that an earlier run of the request wrote whole, over the same
    driver keys and filter, are kept."""
    secret = protect.encrypted_key_columns(meta) if encrypt else []
    if secret and env_key is None:
        raise ValueError(f"{meta.table_name}: no key to encrypt {secret}")
    if driver_keys is not None and meta.keys_encrypted:
        driver_keys = protect.prepare_keys(driver_keys, meta, driver_keys.columns,
                                           env_key=env_key, column_keys=column_keys)
    with audit.recorded(spark, meta.request_id, "EXTRACT", audit_path) as done:
        done.records = _write(spark, tables, meta, out_path, fmt, secret, env_key, driver_keys,
                              driver_filter, key_base, primary_keys, column_keys or {}, strategy,
                              remove_empty)
    return done.record()


def _write(spark: SparkSession, tables, meta: TableMeta, out_path: str, fmt: str, secret,
           env_key, driver_keys, driver_filter, key_base, primary_keys, column_keys,
           strategy: str, remove_empty: bool) -> int:
    rows = extract_plan(tables, meta, driver_keys=driver_keys, driver_filter=driver_filter,
                        primary_keys=primary_keys, strategy=strategy)
    rows = protect.decrypt_with_column_keys(rows, meta, column_keys)
    rows = protect.encrypt_columns(rows, secret, env_key)
    relational = bool(meta.edges) and not meta.is_own_driver
    n = audit.gated_write(rows, lambda d: write_files(d, out_path, fmt), probe=not relational,
                          undo=(lambda: remove_path(spark, out_path)) if remove_empty else None)
    if n and key_base and meta.edges and not meta.is_own_driver:
        chain = subset.key_chain(tables, meta, primary_keys or {}, driver_keys=driver_keys,
                                 driver_filter=driver_filter, fold=False)
        inputs = [str(driver_filter), driver_keys is not None and str(
            reconcile.fingerprint(driver_keys))]
        subset.write_level_keys(chain, meta, primary_keys or {}, key_base, inputs=str(inputs))
    return n
