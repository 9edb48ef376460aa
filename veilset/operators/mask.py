"""Scrub: replace PII by synthetic identities, consistently across tables
(P8, J6, J7, J10, M1-M19).

Plan for a table ``T`` that is ``n`` hops from the driver::

    link = driver rows (keys only)
           JOIN hop tables (key columns only), carrying the driver key
           [GROUP BY parent(T)'s hop columns, unless they are a key verified
            unique in the data]
    out  = T JOIN link ON T's hop columns              (one shuffle of T)
           SELECT one mask expression per column

With the identity generator the identity fields are expressions of the
driver key, evaluated on the link, so no identity join exists at all.  A stored identity table joins
the driver rows (both keyed by the driver key) and its fields ride along the
link; for a one-hop table it joins after the link instead, on T's own hop
column, so T's join keeps a shuffle on both sides for AQE to split a hot key.
The inner join with the link is also the extract (T rows whose parent key
was reached), so extract and mask are one join.  AQE broadcasts the link only
when its materialised size is under the adaptive threshold.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..catalog import ColumnMeta, TableMeta
from ..functions import identity as idfn
from ..functions.masks import choice_column, derived_fields, mask_json
from ..functions.rules import Choice, identity_key, resolve, typed_constant_value
from .subset import _check_edges, covers_key, driver_rows, key_column, q, same_key

ID = "__id_"
DRIVER_KEY = "__driver_key"


def identity_generator(seed: str) -> idfn.IdentityGenerator:
    """Identities as expressions of the driver key (no identity table, no join)."""
    return idfn.IdentityGenerator(seed)


def identity_table(keys: DataFrame, key_col: str, *, seed: str,
                   fields: Sequence[str] = idfn.FIELDS, unique: bool = False,
                   numbers: DataFrame | None = None) -> DataFrame:
    """One synthetic person per key of ``keys[key_col]``.

    ``unique=True`` states the keys are already distinct (a primary key), which
    saves the de-duplicating shuffle.  ``numbers`` (``dense.dense_numbers`` of the
    keys) lets keys that are no whole numbers have unique card, national and bank
    numbers too: one per key, as the numbers are."""
    k = keys.select(key_column(keys, key_col).alias("__k")).dropna()
    k = k if unique else k.distinct()
    if idfn.NUMBERS.intersection(fields):
        k = spread(k)
    if numbers is None:
        return k.select(*idfn.identity_columns(F.col("__k"), fields, seed))
    at = numbers.select(F.col(key_col).alias("__n"), F.col("number").alias("__number"))
    k = k.join(at, k["__k"] == at["__n"])
    return k.select(*idfn.identity_columns(F.col("__k"), fields, seed, F.col("__number")))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out over as many tasks as a shuffle has.  Encrypted numbers cost
    far more per row than reading it, and a small file is read by one task; a fixed
    number of partitions, as adaptive execution joins them by bytes, not by work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


# ---------------------------------------------------------------------------
# planning (driver side, over metadata only)

def has_driver(meta: TableMeta) -> bool:
    return meta.driver_table is not None and meta.driver_column is not None


def mask_plan(meta: TableMeta, columns: Sequence[str] | None = None) -> dict[str, Choice]:
    drv = has_driver(meta)
    names = columns or meta.names
    return {n: resolve(meta.column(n), drv) for n in names}


def nested_plan(meta: TableMeta) -> dict[str, list[tuple[list[str], Choice]]]:
    """Per JSON column, the PII attribute paths and their choices."""
    drv = has_driver(meta)
    out = {}
    for c in meta.columns:
        items = []
        for a in c.nested:
            if not a.is_pii:
                continue
            pseudo = ColumnMeta(name=a.path.split(".")[-1], data_type=a.data_type,
                                is_pii=True, rule=a.rule)
            items.append((a.path.split("."), resolve(pseudo, drv)))
        if items:
            out[c.name] = items
    return out


def needed_fields(plan: Mapping[str, Choice],
                  nested: Mapping[str, list[tuple[list[str], Choice]]]) -> list[str]:
    fields = set()
    for ch in plan.values():
        fields |= derived_fields(ch)
    for items in nested.values():
        for _, ch in items:
            fields |= derived_fields(ch)
    return sorted(fields)


# ---------------------------------------------------------------------------
# identity link

MATCHED = ID + "__matched"


def _identity_side(identity: DataFrame, meta: TableMeta, fields: Sequence[str]) -> DataFrame:
    key = identity_key(meta.driver_rule, meta.driver_column)
    return identity.select(F.col(key).alias("__idkey"), F.lit(True).alias(MATCHED),
                           *[F.col(f).alias(ID + f) for f in fields])


def identity_link(tables: Mapping[str, DataFrame], meta: TableMeta, identity,
                  fields: Sequence[str], *, how: str = "inner",
                  driver_keys: DataFrame | None = None, driver_filter: Column | None = None,
                  unique_keys: Mapping[str, Sequence[str]] | None = None
                  ) -> tuple[DataFrame, list[tuple[str, str]]]:
    """The parent-side hop columns of ``meta``'s last hop, each with its
    driver key and (for a stored identity table) the identity fields.

    The hops are walked with key columns only.  A stored identity table joins
    the driver rows first (both keyed by the driver key) and its fields are
    carried along; an ``IdentityGenerator`` needs no join at all.  When every
    hop's parent columns are a key of that parent known to be unique in the
    data (``unique_keys``, see ``validate.unique_key_tables``; a declared key
    the data breaks would multiply rows), each parent key is reached once and
    the link is used as it is; otherwise a grouping keeps one driver per
    parent key (the smallest).  Returns the link and the join pairs
    (column of T, column of the link).  ``how="left"`` keeps parent keys whose
    driver has no identity (fields NULL, ``MATCHED`` NULL)."""
    groups = _check_edges(meta)
    last = groups[-1]
    dtab = meta.driver_table.lower()
    dcol = meta.driver_column.split(",")[0].strip()
    drv = driver_rows(tables, meta, driver_keys=driver_keys, driver_filter=driver_filter)
    first = {dcol.lower(): dcol, **{e.parent_column.lower(): e.parent_column for e in groups[0]}}
    cur = drv.select(*[F.col(c).alias(q(dtab, c)) for c in first.values()])
    generated = isinstance(identity, idfn.IdentityGenerator)
    # one hop + stored identity: the link would be keyed like the final join,
    # leaving no shuffle under it for AQE to split a hot key of T; the identity
    # is then joined after the link (``attach_identity``) instead of here
    late = not generated and len(groups) == 1
    made: Sequence[str] = ()
    if generated:
        cur = cur.withColumn(MATCHED, F.lit(True))
        made, fields = fields, []
    elif late:
        fields = []
    else:
        ids = _identity_side(identity, meta, fields)
        cur = cur.join(ids, same_key(cur, q(dtab, dcol), ids, "__idkey"),
                       "inner" if how == "inner" else "left").drop("__idkey")
    cur = cur.withColumn(DRIVER_KEY, key_column(cur, q(dtab, dcol)))
    carried = [DRIVER_KEY] + ([] if late else [MATCHED]) + [ID + f for f in fields]
    if late and [q(e.parent_table, e.parent_column) for e in last] == [q(dtab, dcol)]:
        # the hop column is the driver key: the identity joins T's own hop
        # column, whose partitioning the first join already made
        carried = []
    unique = covers_key(dtab, [dcol], unique_keys)
    for i, group in enumerate(groups[:-1]):
        child = group[0].child_table.lower()
        nxt = {e.parent_column.lower(): e.parent_column for e in groups[i + 1]}
        hop = {e.child_column.lower(): e.child_column for e in group}
        cdf = tables[child].select(*[F.col(c).alias(q(child, c))
                                     for c in {**hop, **nxt}.values()])
        cond = reduce(lambda a, b: a & b, [
            same_key(cur, q(e.parent_table, e.parent_column),
                     cdf, q(e.child_table, e.child_column)) for e in group])
        unique = unique and covers_key(group[0].parent_table, [e.parent_column for e in group],
                                       unique_keys)
        cur = cur.join(cdf, cond, "inner").select(
            *[cur[c] for c in carried], *[cdf[q(child, c)] for c in nxt.values()])
    pcols = [q(e.parent_table, e.parent_column) for e in last]
    unique = unique and covers_key(last[0].parent_table, [e.parent_column for e in last],
                                   unique_keys)
    # one link row per key as keys are compared
    cur = cur.select(*[key_column(cur, c).alias(c) for c in pcols],
                     *[c for c in carried if c not in pcols])
    if unique:
        link = cur.select(*pcols, *carried)
    else:
        best = F.min(F.struct(*[F.col(c) for c in carried])).alias("__best")
        link = cur.groupBy(*pcols).agg(best).select(
            *pcols, *[F.col(f"__best.{c}").alias(c) for c in carried])
    if made:
        # generated fields once per parent key, not per row of T
        link = link.withColumns({ID + f: identity.field(f, F.col(DRIVER_KEY)) for f in made})
    pairs = [(e.child_column, q(e.parent_table, e.parent_column)) for e in last]
    return link, pairs


def driver_link(tables: Mapping[str, DataFrame], meta: TableMeta,
                unique_keys: Mapping[str, Sequence[str]] | None = None, *,
                identity=None, fields: Sequence[str] = (),
                how: str = "inner", driver_keys: DataFrame | None = None,
                driver_filter: Column | None = None):
    """Link of ``meta``'s table to its driver (see ``identity_link``); the
    fields default to those the table's mask plan reads."""
    if identity is None:
        raise ValueError("a driver link needs an identity table or generator")
    if not fields:
        fields = needed_fields(mask_plan(meta), nested_plan(meta))
    return identity_link(tables, meta, identity, fields, how=how, driver_keys=driver_keys,
                         driver_filter=driver_filter, unique_keys=unique_keys)


def link_from_key_tables(levels: Mapping[str, DataFrame], meta: TableMeta,
                         unique_keys: Mapping[str, Sequence[str]] | None = None
                         ) -> tuple[DataFrame, list[tuple[str, str]]]:
    """J7 from the key tables an extract wrote (K5), not from the sources.

    ``levels`` maps a parent table to its key table (columns
    ``table__column``, as ``subset.undotted`` reads them back).  The level of
    the last hop's parent holds that parent's key and the level below it; the
    levels are joined downwards (keys only) until the driver key is present.
    The result has the same shape as ``identity_link`` with an identity
    generator: parent hop columns, driver key, ``MATCHED``."""
    groups = _check_edges(meta)
    last = groups[-1]
    dkey = q(meta.driver_table, meta.driver_column.split(",")[0].strip())
    pcols = [q(e.parent_table, e.parent_column) for e in last]
    link = levels[last[0].parent_table.lower()]
    i = len(groups) - 1
    while dkey not in link.columns:
        if i == 0:
            raise ValueError(f"key tables do not lead to the driver key {dkey}")
        i -= 1
        below = levels[groups[i][0].parent_table.lower()]
        common = [c for c in link.columns if c in below.columns]
        if not common:
            raise ValueError("consecutive key tables share no key column")
        link = link.join(below, common, "inner")
    unique = all(covers_key(g[0].parent_table, [e.parent_column for e in g], unique_keys)
                 for g in groups)
    link = link.select(*[key_column(link, c).alias(c) for c in pcols],
                       key_column(link, dkey).alias(DRIVER_KEY))
    if not unique:
        link = link.groupBy(*pcols).agg(F.min(DRIVER_KEY).alias(DRIVER_KEY))
    link = link.withColumn(MATCHED, F.lit(True))
    return link, [(e.child_column, q(e.parent_table, e.parent_column)) for e in last]


# ---------------------------------------------------------------------------
# the scrub itself

def attach_identity(df: DataFrame, meta: TableMeta, identity: DataFrame | None,
                    fields: Sequence[str], *, link: DataFrame | None = None,
                    pairs: Sequence[tuple[str, str]] = (), how: str = "inner",
                    join: str | None = None) -> DataFrame:
    """J6 (table is its own driver: join the identity on the driver column) or
    J7 (join the identity link on the table's hop columns)."""
    if link is None:
        if identity is None:
            raise ValueError(f"{meta.table_name}: masking needs an identity table")
        if isinstance(identity, idfn.IdentityGenerator):
            dcol = meta.driver_column.split(",")[0].strip()
            if idfn.NUMBERS.intersection(fields):
                df = spread(df)
            return df.withColumn(DRIVER_KEY, key_column(df, dcol))
        ids = _identity_side(identity, meta, fields)
        dcol = meta.driver_column.split(",")[0].strip()
        return df.join(ids, same_key(df, dcol, ids, "__idkey"), how).drop("__idkey")
    cond = reduce(lambda a, b: a & b, [same_key(df, t, link, k) for t, k in pairs])
    # a row per parent key: hashed in memory, so that neither side is sorted (T's rows
    # would fill a task's memory) and the hot keys of T can still be split
    joined = df.join(link.hint("shuffle_hash"), cond, join or how).drop(*[k for _, k in pairs])
    if MATCHED not in link.columns:       # stored identity joined after the link
        ids = _identity_side(identity, meta, fields)
        dk = DRIVER_KEY if DRIVER_KEY in link.columns else pairs[0][0]
        joined = joined.join(ids, same_key(joined, dk, ids, "__idkey"),
                             "inner" if how == "inner" else "left").drop("__idkey")
    if how == "inner":
        joined = joined.where(F.col(MATCHED).isNotNull())
    return joined


def unmatched(df: DataFrame, meta: TableMeta, identity: DataFrame | None = None, *,
              link: DataFrame | None = None, pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Rows the inner identity join would drop (``link`` built with
    ``how="left"``)."""
    if link is None:
        ids = _identity_side(identity, meta, [])
        dcol = meta.driver_column.split(",")[0].strip()
        return df.join(ids, same_key(df, dcol, ids, "__idkey"), "left_anti")
    if MATCHED in link.columns:
        hit = link.where(F.col(MATCHED).isNotNull())
    else:
        ids = _identity_side(identity, meta, [])
        dk = DRIVER_KEY if DRIVER_KEY in link.columns else pairs[0][1]
        hit = link.join(ids, same_key(link, dk, ids, "__idkey"), "left_semi")
    cond = reduce(lambda a, b: a & b, [same_key(df, t, hit, k) for t, k in pairs])
    return df.join(hit, cond, "left_anti")


def scrub(df: DataFrame, meta: TableMeta, identity: DataFrame | None = None, *,
          link: DataFrame | None = None, pairs: Sequence[tuple[str, str]] = (),
          how: str = "inner",
          columns: Sequence[str] | None = None, join: str | None = None) -> DataFrame:
    """The masked table, same columns and types as ``df``.

    ``how="inner"`` drops rows without an identity (the reference's join);
    ``how="left"`` keeps them with typed constants in the masked columns.
    ``join`` overrides the join with the link (``"inner"`` with ``how="left"``:
    rows must be reached from the driver, but may lack an identity).
    """
    names = list(columns or df.columns)
    plan = mask_plan(meta, names)
    nested = {k: v for k, v in nested_plan(meta).items() if k in names}
    fields = needed_fields(plan, nested)
    work = df
    if has_driver(meta) and (fields or link is not None):
        work = attach_identity(df, meta, identity, fields, link=link, pairs=pairs, how=how,
                               join=join)

    if isinstance(identity, idfn.IdentityGenerator):
        def idf(f: str) -> Column:
            # the link may bring the field along
            return F.col(ID + f) if link is not None and ID + f in link.columns \
                else identity.field(f, F.col(DRIVER_KEY))
    else:
        def idf(f: str) -> Column:
            return F.col(ID + f)

    schema = df.schema
    out = []
    for n in names:
        dtype = schema[n].dataType
        cm = meta.column(n)
        fb = typed_constant_value(cm) if how != "inner" else None
        col = choice_column(plan[n], F.col(n), dtype, idf, fallback=fb)
        if n in nested:
            col = mask_json(col, [(path, partial(_nested_value, choice, idf=idf))
                                  for path, choice in nested[n]])
        out.append(col.alias(n))
    return work.select(*out)


def _nested_value(choice: Choice, ftype: T.DataType, *, idf) -> Column:
    return choice_column(choice, F.lit(None), ftype, idf)


def describe(meta: TableMeta) -> str:
    """Human-readable mask plan (for logs and reviews; no data)."""
    plan = mask_plan(meta)
    return json.dumps({k: [v.kind, v.field, str(v.value) if v.value is not None else None]
                       for k, v in plan.items()}, indent=1)
