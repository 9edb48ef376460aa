"""Scrub job (reference lifecycle 3.2) as one lazy plan:
source -> identity link -> masked projection -> write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ..catalog import TableMeta
from ..operators import audit, mask, subset
from ..session import remove_path
from ..sinks.files import stage_copy, write_files
from ..sources.files import STAGE_SUFFIX, read_declared


def scrub_related(tables: Mapping[str, DataFrame], meta: TableMeta,
                  identity=None, *,
                  driver_filter: Column | None = None, driver_keys: DataFrame | None = None,
                  how: str = "inner",
                  unique_keys: Mapping[str, list[str]] | None = None) -> DataFrame:
    """Extract ``meta``'s table over its hops and mask it, in one join.

    The identity link holds exactly the parent keys reached from the driver,
    so joining the target with it both restricts the rows (the extract) and
    attaches the identity fields (the mask).  A table without PII is only
    extracted; a table without driver gets typed constants."""
    target = tables[meta.table_name.lower()]
    if not mask.has_driver(meta) or not meta.has_pii:
        rows = subset.extract_related(tables, meta, driver_keys=driver_keys,
                                      driver_filter=driver_filter,
                                      primary_keys=unique_keys) if meta.edges else \
            subset.extract_rows(target, meta)
        return mask.scrub(rows, meta, identity)
    if meta.is_own_driver:
        rows = subset.extract_related(tables, meta, driver_keys=driver_keys,
                                      driver_filter=driver_filter)
        return mask.scrub(rows, meta, identity, how=how)
    link, pairs = mask.driver_link(tables, meta, unique_keys, identity=identity, how=how,
                                   driver_keys=driver_keys, driver_filter=driver_filter)
    rows = subset.extract_rows(target, meta)          # the request's own filters
    return mask.scrub(rows, meta, identity, link=link, pairs=pairs, how=how, join="inner")


def run_scrub(spark: SparkSession, rows: DataFrame, meta: TableMeta, out_path: str, *,
              identity=None, link: DataFrame | None = None,
              pairs=(), fmt: str = "parquet", how: str = "inner",
              unmatched_path: str | None = None, audit_path: str | None = None) -> DataFrame:
    """Mask extracted rows and write them; returns the job's audit record.

    Rows that have no identity are left out by the inner join: their primary keys
    (nothing else, as they are not masked) are written to ``unmatched_path``, by
    default ``<out_path>_unmatched``; no folder if there are none.  A table without
    PII is copied to its stage ``<out_path>_stg``.  With ``audit_path`` the record
    is appended there, with FAILED if the job fails."""
    with audit.recorded(spark, meta.request_id, "SCRUB", audit_path) as done:
        if not meta.has_pii:
            done.records = audit.write_counted(
                rows, lambda d: write_files(d, f"{out_path}{STAGE_SUFFIX}", fmt))
            return done.record()
        masked = mask.scrub(rows, meta, identity, link=link, pairs=pairs, how=how)
        done.records = audit.write_counted(masked, lambda d: write_files(d, out_path, fmt))
        if how == "inner" and mask.has_driver(meta) and (
                link is not None or isinstance(identity, DataFrame)):
            left_out = unmatched_path or f"{out_path}_unmatched"
            missed = mask.unmatched(rows, meta, identity, link=link, pairs=pairs)
            audit.gated_write(missed.select(*(meta.primary_key or [p[0] for p in pairs])),
                              lambda d: write_files(d, left_out, fmt), probe=False,
                              undo=lambda: remove_path(spark, left_out))
    return done.record()


def run_scrub_folder(spark: SparkSession, base: str, metas, *, identity=None, links=None,
                     fmt: str = "csv", how: str = "inner",
                     audit_path: str | None = None) -> dict[str, DataFrame]:
    """The scrub job over a request's extracted files: ``base/<table>`` of every
    table, read with its declared types, masked to ``base/<table>_final``; a table
    without PII is copied as it is to ``base/<table>_stg``.

    ``links`` maps a table to its identity link and join pairs (see
    ``mask.driver_link`` and ``mask.link_from_key_tables``).  Returns the audit
    record of each table."""
    out = {}
    for meta in metas:
        name = meta.table_name.lower()
        if not meta.has_pii:
            with audit.recorded(spark, meta.request_id, "SCRUB", audit_path) as done:
                copied = Observation("copied")
                stage_copy(spark, f"{base}/{name}", f"{base}/{name}{STAGE_SUFFIX}", fmt,
                           counted=copied)
                done.records = int(copied.get["rows"])
            out[name] = done.record()
            continue
        link, pairs = (links or {}).get(name, (None, ()))
        rows = read_declared(spark, f"{base}/{name}", meta, fmt)
        out[name] = run_scrub(spark, rows, meta, f"{base}/{name}_final", identity=identity,
                              link=link, pairs=pairs, fmt=fmt, how=how, audit_path=audit_path)
    return out


def scrub_request(tables: Mapping[str, DataFrame], metas, identity=None, *,
                  driver_filter: Column | None = None, driver_keys: DataFrame | None = None,
                  how: str = "inner",
                  unique_keys: Mapping[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """All tables of one request, masked; each distinct identity link is built
    once.

    Tables that reach the driver by the same inner hops share one link; a
    link used by more than one table is checkpointed to the shared checkpoint
    folder (cut lineage, survives executor loss) instead of re-running its
    hop joins per table.  Returns ``table -> masked DataFrame`` (lazy except
    for the shared links)."""
    from ..session import scratch_root

    out: dict[str, DataFrame] = {}
    shared: dict[tuple, list] = {}
    for meta in metas:
        if mask.has_driver(meta) and meta.has_pii and not meta.is_own_driver and meta.edges:
            groups = subset._check_edges(meta)
            # every edge of the inner hops with both its ends (two tables may
            # reach the driver by different columns of one table), the columns
            # that the last hop leaves, and the driver with its rule
            sig = (tuple((e.parent_table.lower(), e.parent_column.lower(),
                          e.child_table.lower(), e.child_column.lower(), e.index)
                         for g in groups[:-1] for e in g),
                   tuple((e.parent_table.lower(), e.parent_column.lower()) for e in groups[-1]),
                   meta.driver_table.lower(), meta.driver_column.lower(), meta.driver_rule)
            shared.setdefault(sig, []).append(meta)
        else:
            out[meta.table_name.lower()] = scrub_related(
                tables, meta, identity, driver_filter=driver_filter, driver_keys=driver_keys,
                how=how, unique_keys=unique_keys)
    for members in shared.values():
        fields = sorted({f for m in members
                         for f in mask.needed_fields(mask.mask_plan(m), mask.nested_plan(m))})
        link, _ = mask.driver_link(tables, members[0], unique_keys, identity=identity,
                                   fields=fields or ["cust_id"], how=how,
                                   driver_keys=driver_keys, driver_filter=driver_filter)
        if len(members) > 1:
            scratch_root(link.sparkSession)
            link = link.checkpoint(eager=True)
        for meta in members:
            last = subset._check_edges(meta)[-1]
            pairs = [(e.child_column, subset.q(e.parent_table, e.parent_column)) for e in last]
            rows = subset.extract_rows(tables[meta.table_name.lower()], meta)
            out[meta.table_name.lower()] = mask.scrub(
                rows, meta, identity, link=link, pairs=pairs, how=how, join="inner")
    return out
