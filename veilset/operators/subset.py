"""Referentially consistent subsets.

The reference builds SQL text with ``(1, col) IN ((1,'v'), ...)`` lists that
are collected to the driver.  Here a key list is a DataFrame and every hop is
a join, so key sets of any size stay distributed:

* ``semi_join``: a table restricted to a key set (left semi join; tuple-wise
  by default, per column on request).  With ``strategy="isin"`` a short
  key set (one bounded collect, an error beyond ``isin_limit`` keys) becomes
  an ``IN`` list, which the Parquet / JDBC scan takes as a pushed filter.
* ``extract_related`` / ``hop_keys``: the target's rows / keys, reached from
  the driver by one semi join per hop (edges with the same ``index`` form one
  composite hop), shuffling projected join columns only.
* ``key_chain``: all keys of every hop side by side (one row per target key),
  for key tables and for tying rows back to their driver.

Skew: a hot key on the streamed side of a semi / inner join is split by AQE's
skew-join rule (left side splittable for inner, semi, anti and left outer
joins) - provided the key side comes straight from a shuffle.  Key sets that
project the parent's declared key are therefore not aggregated; others are
de-duplicated with a partial (map-side) aggregate first.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import csvio
from ..catalog import Edge, TableMeta
from ..functions.predicates import request_filter
from ..session import path_exists, remove_path, scratch_root
from ..sinks.files import write_files
from . import reconcile, runs

JoinPairs = Sequence[tuple[str, str]]   # (column of the table, column of the key set)


def q(table: str, column: str) -> str:
    """Internal name of a key column in key sets and chains: ``table__column``."""
    return f"{table.lower()}__{column.lower()}"


def dotted(df: DataFrame) -> DataFrame:
    """P5: ``table__column`` -> ``TABLE.COLUMN`` names, for writing key tables."""
    return df.toDF(*[
        n.replace("__", ".", 1).upper() if "__" in n else n for n in df.columns
    ])


def undotted(df: DataFrame) -> DataFrame:
    """Inverse of :func:`dotted` for key tables read back from files."""
    return df.toDF(*[n.lower().replace(".", "__", 1) for n in df.columns])


def typed_keys(keys: DataFrame, pairs: JoinPairs, target: DataFrame, *,
               unique: bool = False) -> DataFrame:
    """Key columns cast to the target column types, NULL keys dropped, and
    de-duplicated unless ``unique`` says they already are.

    A NULL key matches nothing, as in any equi-join.  Text is compared without
    padding at its end (on the table's side too, see ``key_column``).  A key
    that the column's type cannot hold exactly (1.7 for a whole number, 1.234
    for two digits behind the point, a time of day for a plain date, text that
    is no number) is an error: it must not match another key.
    """
    tschema = target.schema
    cols = []
    for t, k in pairs:
        c, own, want = F.col(k), keys.schema[k].dataType, tschema[t].dataType
        if isinstance(own, T.StringType):
            c = F.rtrim(c)          # key lists arrive right-padded
        cols.append(exact_cast(c, own, want, t).alias(k))
    out = keys.select(*cols).dropna(how="any")
    return out if unique else out.distinct()


def exact_cast(c: Column, own: T.DataType, want: T.DataType, name: str) -> Column:
    """``c`` (of type ``own``) as ``want``; a value that the type cannot hold
    exactly is an error."""
    if own == want or isinstance(want, T.StringType):
        return c.cast(want)
    cast = c.try_cast(want)
    if isinstance(own, T.StringType):
        # compare in a type that holds what the text says
        if isinstance(want, T.DecimalType):
            wide = T.DecimalType(38, 38 - (want.precision - want.scale))
        elif isinstance(want, T.IntegralType):
            wide = T.DecimalType(38, 18)
        elif isinstance(want, T.DateType):
            wide = T.TimestampNTZType()
        else:
            wide = want
        kept = cast.cast(wide) == c.try_cast(wide)
    else:
        kept = cast.try_cast(own) == c
    what = "is not a whole number" if isinstance(want, T.IntegralType) else \
        f"cannot be held exactly as {want.simpleString()}"
    return F.when(c.isNull() | kept, cast).otherwise(F.raise_error(F.concat(
        F.lit(f"key for {name} {what}: "), c.cast("string"))).cast(want))


def key_column(df: DataFrame, name: str) -> Column:
    """A table's key column as keys are compared with it: text unpadded."""
    return unpadded(df[name], df.schema[name].dataType)


def unpadded(column: Column, dtype: T.DataType) -> Column:
    """A key value as keys are compared: text without padding at its end."""
    return F.rtrim(column) if isinstance(dtype, T.StringType) else column


def same_key(a: DataFrame, a_name: str, b: DataFrame, b_name: str) -> Column:
    """Equality of two tables' key columns, text compared without padding."""
    return key_column(a, a_name) == key_column(b, b_name)


IN_LIST_MAX = 1000      # values per IN list a source database accepts


def in_lists(column: Column | str, values: Sequence) -> Column:
    """``column IN (...)`` as OR-ed lists of at most ``IN_LIST_MAX`` values, so
    a pushed filter never exceeds what the source database takes."""
    chunks = [values[i:i + IN_LIST_MAX] for i in range(0, len(values), IN_LIST_MAX)]
    col = F.col(column) if isinstance(column, str) else column
    return reduce(lambda a, b: a | b, [col.isin(list(c)) for c in chunks])


STRATEGIES = ("join", "isin", "runs")


def semi_join(df: DataFrame, keys: DataFrame, pairs: JoinPairs, *,
              match: str = "tuple", strategy: str = "join",
              isin_limit: int = 1000, unique: bool = False) -> DataFrame:
    """Rows of ``df`` whose key columns appear in ``keys``.

    match="tuple": composite keys compared as tuples (default).
    match="per_column": each column tested on its own and ANDed (the
    reference's reading: keys (1,a),(2,b) also admit (1,b)).
    unique=True: the key set is known to be duplicate-free (a primary-key
    projection), so no aggregate sits between its shuffle and the join and
    AQE can split a hot key of ``df`` (its skew-join rule needs both join
    inputs to come straight from a shuffle).  Otherwise keys are de-duplicated
    first (a partial aggregate: hot duplicates collapse map-side).
    strategy="isin" is the caller's choice for short key lists against a
    source database: the distinct keys (one bounded collect, an error beyond
    ``isin_limit``) become IN lists of ``IN_LIST_MAX`` that are pushed into
    the scan.
    strategy="runs" covers the first key column by a few intervals
    (``runs.key_runs``) that are pushed into the scan before the exact join: for
    key sets of any size that lie together.
    """
    if match not in ("tuple", "per_column"):
        raise ValueError(f"unknown match {match!r}")
    if match == "per_column" and len(pairs) > 1:
        for t, k in pairs:
            df = semi_join(df, keys, [(t, k)], strategy=strategy, isin_limit=isin_limit)
        return df
    kset = typed_keys(keys, pairs, df, unique=unique)
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy == "runs":
        t, k = pairs[0]
        df = df.where(runs.in_runs(df[t], df.schema[t].dataType, runs.key_runs(kset, k)))
    if strategy == "isin" and len(pairs) == 1:
        # one bounded job: at most isin_limit + 1 distinct keys reach the driver
        probe = (kset.distinct() if unique else kset).limit(isin_limit + 1).collect()
        t, _ = pairs[0]
        if len(probe) <= isin_limit:
            values = [r[0] for r in probe]
            return df.where(in_lists(key_column(df, t), values)) if values \
                else df.where(F.lit(False))
        raise ValueError(f"more than {isin_limit} keys for {t}: use strategy='join'")
    cond = [key_column(df, t) == kset[k] for t, k in pairs]
    return df.join(kset, reduce(lambda a, b: a & b, cond), "left_semi")


def extract_rows(df: DataFrame, meta: TableMeta | None = None, *,
                 keys: DataFrame | None = None, pairs: JoinPairs = (),
                 match: str = "tuple", where: Column | None = None) -> DataFrame:
    """Full extract, key extract, filter extract, or both.

    ``keys=None`` and no filter: the whole table (F12).  An empty key set
    selects nothing (F16), as the semi join gives no rows.
    """
    out = df
    if keys is not None:
        if not pairs:
            raise ValueError("key extract needs the key columns")
        out = semi_join(out, keys, pairs, match=match)
    cond = where
    if cond is None and meta is not None and meta.filters:
        cond = request_filter(meta, df.schema)
    if cond is not None:
        out = out.where(cond)
    return out


LIMIT_IN_ONE_TASK = 100_000     # a limit up to here is merged in one task


def apply_order_limit(df: DataFrame, meta: TableMeta | None = None, *,
                      order: Sequence[str] = (), limit: int | None = None,
                      one_task: int = LIMIT_IN_ONE_TASK) -> DataFrame:
    """``FETCH FIRST n ROWS``; with an order a top-k.

    Without an explicit order the primary key orders the rows, so the result
    is deterministic (a bare limit would be any n rows).  A limit up to
    ``one_task`` is planned as TakeOrderedAndProject: a per-partition top-k, then
    one merge of k rows per partition.  A larger one is cut by ranks (see
    ``first_rows``), sorted again if an order was asked for.
    """
    wanted = list(order or (meta.order if meta else ()))
    order = wanted or list((meta.primary_key if meta else ()))
    limit = limit if limit is not None else (meta.limit if meta else None)
    if limit is None:
        return df.orderBy(*order) if order else df
    if not order:
        raise ValueError("a row limit needs an order (or a primary key) to be deterministic")
    if int(limit) <= one_task:
        return df.orderBy(*order).limit(int(limit))
    rows = first_rows(df, order, int(limit), one_task=one_task)
    return rows.orderBy(*order) if wanted else rows


def first_rows(df: DataFrame, order: Sequence[str], n: int, *,
               one_task: int = LIMIT_IN_ONE_TASK) -> DataFrame:
    """The first ``n`` rows by ``order`` (ascending, NULLs first), in no task more
    than a range of them.

    The order columns alone are dealt out by range; the ranges' counts and ends (a
    row per range, from one job) tell in which range rank ``n`` falls.  Ranges
    before it are taken whole, by a comparison with its lower end that the scan
    can use; in it the search goes on, until at most ``one_task`` rows are left to
    rank or all of them are equal.  With ``one_task=1`` and an order that tells all
    rows apart, the result is a filter and nothing else."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(c) for c in order])
    types = T.StructType([df.schema[c] for c in order])

    def end(row) -> Column:
        return F.struct(*[F.lit(v).cast(f.dataType) for v, f in zip(row, types, strict=True)])

    def upto(row) -> Column:
        first = F.col(order[0])
        near = first.isNull() if row[0] is None else \
            first.isNull() | (first <= F.lit(row[0]).cast(types[0].dataType))
        return near & (key <= end(row))

    low = high = None          # rank n lies behind low, not behind high
    left = n
    while True:
        some = df
        if low is not None:
            some = some.where(~(key <= end(low)))
        if high is not None:
            some = some.where(upto(high))
        ranges = sorted(((r["lo"], r["hi"], r["n"]) for r in some.select(*order)
                         .repartitionByRange(parts, *order)
                         .select(key.alias("k"), F.spark_partition_id().alias("p"))
                         .groupBy("p").agg(F.min("k").alias("lo"), F.max("k").alias("hi"),
                                           F.count(F.lit(1)).alias("n")).collect()),
                        key=lambda r: [(v is not None, v) for v in r[0]])
        for lo, hi, rows in ranges:
            if left < rows:
                break
            left -= rows
            low = hi
        else:                  # all rows up to here are wanted
            return df if high is None else df.where(upto(high))
        high = hi
        if rows <= one_task or lo == hi:
            break
    if not left:               # the rank falls between two ranges: a plain filter
        return df.where(F.lit(False) if low is None else upto(low))
    rest = df.where(upto(high))
    rest = rest if low is None else rest.where(~(key <= end(low)))
    rest = rest.orderBy(*order).limit(left)
    return rest if low is None else df.where(upto(low)).unionByName(rest)


# ---------------------------------------------------------------------------
# multi-hop key sets

def _groups(edges: Sequence[Edge]) -> list[list[Edge]]:
    by: dict[int, list[Edge]] = {}
    for e in edges:
        by.setdefault(e.index, []).append(e)
    out = []
    for _, group in sorted(by.items()):
        parents = {e.parent_table.lower() for e in group}
        children = {e.child_table.lower() for e in group}
        if len(parents) != 1 or len(children) != 1:
            raise ValueError(f"edges with one index must join one parent to one child: {group}")
        out.append(group)
    return out


def _check_edges(meta: TableMeta) -> list[list[Edge]]:
    if not meta.edges:
        raise ValueError(
            f"{meta.table_name}: relational extract needs a table relationship")
    if not meta.driver_table or not meta.driver_column:
        raise ValueError(f"{meta.table_name}: relational extract needs a driver column")
    groups = _groups(meta.edges)
    if groups[0][0].parent_table.lower() != meta.driver_table.lower():
        raise ValueError("the lowest hop must start at the driver table")
    return groups


def driver_rows(tables: Mapping[str, DataFrame], meta: TableMeta, *,
                driver_keys: DataFrame | None = None,
                driver_filter: Column | None = None, match: str = "tuple",
                strategy: str = "join") -> DataFrame:
    """The driver table restricted by its key list and filter."""
    drv = tables[meta.driver_table.lower()]
    if driver_filter is not None:
        drv = drv.where(driver_filter)
    if driver_keys is not None:
        dcols = [c.strip() for c in meta.driver_column.split(",")]
        kcols = driver_keys.columns[: len(dcols)]
        drv = semi_join(drv, driver_keys, list(zip(dcols, kcols)), match=match,
                        strategy=strategy)
    return drv


def covers_key(table: str, columns: Sequence[str],
               primary_keys: Mapping[str, Sequence[str]] | None) -> bool:
    """True when ``columns`` include the table's whole primary key, so their
    values are unique per row."""
    pk = [c.lower() for c in (primary_keys or {}).get(table.lower(), [])]
    return bool(pk) and set(pk) <= {c.lower() for c in columns}


def _parent_key_set(tables: Mapping[str, DataFrame], meta: TableMeta,
                    groups: list[list[Edge]], driver_keys: DataFrame | None,
                    driver_filter: Column | None,
                    primary_keys: Mapping[str, Sequence[str]] | None = None,
                    strategy: str = "join") -> tuple[DataFrame, bool]:
    """Parent-side columns of the last hop in ``groups`` and whether they are
    unique.

    Each earlier hop is a semi join of the child table with the parent key set;
    only the columns the next hop needs are kept, so what is shuffled is a
    projected key set and never a whole table.  A key set that projects the
    parent's primary key is unique already and is not aggregated (keeps the
    join open to AQE's skew split); any other key set is de-duplicated.
    """
    def project(rows, group):
        table = group[0].parent_table
        cols = [e.parent_column for e in group]
        out = rows.select(*[F.col(c).alias(q(table, c)) for c in cols])
        unique = covers_key(table, cols, primary_keys)
        return (out if unique else out.distinct()), unique

    parent = driver_rows(tables, meta, driver_keys=driver_keys, driver_filter=driver_filter,
                         strategy=strategy)
    pkeys, unique = project(parent, groups[0])
    for i, group in enumerate(groups[:-1]):
        child_name = group[0].child_table.lower()
        nxt = groups[i + 1]
        if nxt[0].parent_table.lower() != child_name:
            raise ValueError("hops must form a chain from the driver to the target")
        pairs = [(e.child_column, q(e.parent_table, e.parent_column)) for e in group]
        rows = semi_join(tables[child_name], pkeys, pairs, unique=True)
        pkeys, unique = project(rows, nxt)
    return pkeys, unique


def hop_keys(tables: Mapping[str, DataFrame], meta: TableMeta, *,
             driver_keys: DataFrame | None = None, driver_filter: Column | None = None,
             upto: int | None = None,
             primary_keys: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Distinct child-side hop columns of hop ``upto`` (default: the last hop),
    named ``child__column``: the keys by which that child is extracted."""
    groups = _check_edges(meta)
    if upto is not None:
        groups = groups[: upto + 1]
    last = groups[-1]
    pkeys, unique = _parent_key_set(tables, meta, groups, driver_keys, driver_filter,
                                    primary_keys)
    pairs = [(e.child_column, q(e.parent_table, e.parent_column)) for e in last]
    rows = semi_join(tables[last[0].child_table.lower()], pkeys, pairs, unique=True)
    return rows.select(*[F.col(e.child_column).alias(q(e.child_table, e.child_column))
                         for e in last]).distinct()


def extract_related(tables: Mapping[str, DataFrame], meta: TableMeta, *,
                    driver_keys: DataFrame | None = None,
                    driver_filter: Column | None = None,
                    primary_keys: Mapping[str, Sequence[str]] | None = None,
                    strategy: str = "join") -> DataFrame:
    """Rows of the target table reached from the driver over all hops,
    then the request's own filter.  One semi join per hop.  ``strategy`` is that
    of the driver key list (see ``semi_join``); with ``runs`` the target's keys
    are pushed as intervals too.

    ``primary_keys`` (table -> key columns) lets hops whose parent columns are
    a primary key skip de-duplication, so AQE can split hot keys of the
    (big) child side."""
    if meta.is_own_driver:
        return extract_rows(driver_rows(tables, meta, driver_keys=driver_keys,
                                        driver_filter=driver_filter, strategy=strategy), meta)
    groups = _check_edges(meta)
    last = groups[-1]
    if last[0].child_table.lower() != meta.table_name.lower():
        raise ValueError("the last hop must end at the target table")
    pkeys, _ = _parent_key_set(tables, meta, groups, driver_keys, driver_filter, primary_keys,
                               strategy)
    pairs = [(e.child_column, q(e.parent_table, e.parent_column)) for e in last]
    return extract_rows(semi_join(tables[meta.table_name.lower()], pkeys, pairs, unique=True,
                                  strategy="runs" if strategy == "runs" else "join"), meta)


def key_chain(tables: Mapping[str, DataFrame], meta: TableMeta,
              primary_keys: Mapping[str, Sequence[str]], *,
              driver_keys: DataFrame | None = None,
              driver_filter: Column | None = None, upto: int | None = None,
              fold: bool = True) -> DataFrame:
    """Driver -> parent -> ... -> child, all keys of every hop.

    One inner join per hop index (equal-index edges ANDed into one composite
    condition).  Before each join the next table is projected to its primary
    key, its hop columns and the columns the following hop needs, so only key
    columns are ever shuffled.  Result columns are ``table__column``; a
    child's hop column equals its parent's (text compared without padding at its
    end) and is kept once, under the parent's name (``fold=True``) or under both names (``fold=False``, as key
    tables need every table's own key columns); the rows are distinct (A3).
    """
    groups = _check_edges(meta)
    if upto is not None:
        groups = groups[: upto + 1]

    def needed(table: str) -> list[str]:
        t = table.lower()
        cols = list(primary_keys.get(t, []))
        for g in groups:
            for e in g:
                if e.child_table.lower() == t:
                    cols.append(e.child_column)
                if e.parent_table.lower() == t:
                    cols.append(e.parent_column)
        if t == meta.driver_table.lower():
            cols += [c.strip() for c in meta.driver_column.split(",")]
        seen, out = set(), []
        for c in cols:
            if c.lower() not in seen:
                seen.add(c.lower())
                out.append(c)
        return out

    drv_name = meta.driver_table.lower()
    drv = driver_rows(tables, meta, driver_keys=driver_keys, driver_filter=driver_filter)
    chain = drv.select(*[F.col(c).alias(q(drv_name, c)) for c in needed(drv_name)])
    same: dict[str, str] = {}      # child hop column -> the parent column it equals
    for group in groups:
        child_name = group[0].child_table.lower()
        child = tables[child_name].select(
            *[F.col(c).alias(q(child_name, c)) for c in needed(child_name)])
        cond = reduce(lambda a, b: a & b, [
            same_key(chain, same.get(q(e.parent_table, e.parent_column),
                                     q(e.parent_table, e.parent_column)),
                     child, q(e.child_table, e.child_column))
            for e in group])
        # the child's hop columns equal the parent's: keep one copy
        for e in group:
            pc = q(e.parent_table, e.parent_column)
            same[q(e.child_table, e.child_column)] = same.get(pc, pc)
        chain = chain.join(child, cond, "inner").select(
            *[chain[c] for c in chain.columns],
            *[child[c] for c in child.columns if not fold or c not in same])
    return chain.distinct()


def level_keys(chain: DataFrame, meta: TableMeta,
               primary_keys: Mapping[str, Sequence[str]]) -> list[tuple[str, DataFrame]]:
    """K5: one distinct key table per hop level, from one chain built with
    ``fold=False`` (every table's key columns under its own name).

    Level of parent P holds the keys of the previous level plus P's primary
    key; the last entry is the target table with its primary key.
    """
    groups = _check_edges(meta)
    drv = meta.driver_table.lower()
    last_cols = [q(drv, c.strip()) for c in meta.driver_column.split(",")]
    out = []
    for group in groups:
        parent = group[0].parent_table.lower()
        cols = last_cols + [q(parent, c) for c in primary_keys.get(parent, [])
                            if q(parent, c) not in last_cols]
        out.append((parent, chain.select(*cols).distinct()))
        last_cols = [q(parent, c) for c in primary_keys.get(parent, [])] or cols
    target = meta.table_name.lower()
    cols = [q(target, c) for c in primary_keys.get(target, [])] + \
        [c for c in last_cols if not c.startswith(target + "__")]
    cols = [c for c in cols if c in chain.columns]    # hop columns kept once, parent side
    out.append((target, chain.select(*cols).distinct()))
    return out


def _level_signature(meta: TableMeta, primary_keys: Mapping[str, Sequence[str]],
                     inputs: str) -> str:
    """What a request's key tables depend on besides the data."""
    hops = [[e.index, e.parent_table, e.parent_column, e.child_table, e.child_column]
            for g in _check_edges(meta) for e in g]
    keys = {t: list(k) for t, k in sorted(primary_keys.items())}
    doc = [hops, meta.driver_table, meta.driver_column, keys, inputs]
    return hashlib.sha256(json.dumps(doc).encode()).hexdigest()


def _level_fingerprint(df: DataFrame) -> reconcile.Fingerprint:
    """Of a key table as text, so that files without types compare too."""
    return reconcile.fingerprint(df.select(*[
        F.col(f"`{c}`").cast("string").alias(c) for c in df.columns]))


def _read_level(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        return spark.read.options(**csvio.READ).option("header", True).csv(path)
    return spark.read.format(fmt).load(path)


def level_is_good(spark: SparkSession, base: str, table: str, request_id: str,
                  signature: str, fmt: str = "csv") -> bool:
    """Whether ``base/<table>`` is this request's key table: its record names the
    request and the hops, and its rows and fingerprint are those recorded."""
    mark = f"{base}/_levels/{table}"
    if not path_exists(spark, f"{mark}/_SUCCESS") or not path_exists(spark, f"{base}/{table}"):
        return False
    told = spark.read.schema(_LEVEL).parquet(mark).first()
    if told is None or (told["request_id"], told["signature"]) != (request_id, signature):
        return False
    try:
        got = _level_fingerprint(_read_level(spark, f"{base}/{table}", fmt))
    except PySparkException:                         # not files of that kind
        return False
    return (got.rows, got.sum1, got.sum2) == (told["rows"], int(told["sum1"]), int(told["sum2"]))


_LEVEL = "request_id string, signature string, rows bigint, sum1 string, sum2 string"


def write_level_keys(chain: DataFrame, meta: TableMeta,
                     primary_keys: Mapping[str, Sequence[str]], base: str, *,
                     fmt: str = "csv", inputs: str = "",
                     written: list[str] | None = None) -> dict[str, str]:
    """K5: write each level's key table under ``base/<table>`` with dotted
    ``TABLE.COLUMN`` headers.

    A level is recorded below ``base/_levels`` with its request, a signature of
    the hops (and of ``inputs``, say the driver keys), its rows and fingerprint.  A
    level that is there and agrees with its record is left as it is; a stale, a
    foreign or a half-written one is written again.  ``written`` (if given) gets
    the tables written.

    The chain feeds one write per level, so it is computed once and
    checkpointed to the shared checkpoint folder (not at all if every level is
    good): its multi-hop lineage is cut, and a lost executor costs a re-read, not
    a re-run of the joins."""
    spark = chain.sparkSession
    signature = _level_signature(meta, primary_keys, inputs)
    paths = {t: f"{base}/{t}" for t, _ in level_keys(chain, meta, primary_keys)}
    bad = [t for t in paths
           if not level_is_good(spark, base, t, meta.request_id, signature, fmt)]
    if not bad:
        return paths
    scratch_root(spark)          # a shared checkpoint dir must be set
    chain = chain.checkpoint(eager=True)
    for table, keys in level_keys(chain, meta, primary_keys):
        if table not in bad:
            continue
        remove_path(spark, f"{base}/_levels/{table}")    # the record goes first, comes last
        keys = dotted(keys)
        write_files(keys, paths[table], fmt)
        told = _level_fingerprint(keys)
        spark.createDataFrame([(meta.request_id, signature, told.rows, str(told.sum1),
                                str(told.sum2))], _LEVEL).coalesce(1).write.mode(
            "overwrite").parquet(f"{base}/_levels/{table}")
        if written is not None:
            written.append(table)
    return paths
