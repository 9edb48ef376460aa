"""Table metadata: driver-side description of a table, its columns and edges.

A metadata document (one JSON object per table) is turned into frozen
dataclasses once; every operator reads these instead of raw dicts.  Nothing
here touches data: it only decides which Spark expressions the operators
build.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# fixed values: rule priority for choosing the one PII column that keeps its
# value at extract time (highest number wins)
RULE_PRIORITY: dict[str, int] = {
    "primary_pan_acct_nbr15": 4,
    "primary_pan_acct_nbr13": 3,
    "primary_pan_acct_nbr11": 2,
    "cust_id": 1,
}
# algorithm whose values are one-way hashes: never decrypted, never re-encrypted
KEY_HASH_ALGORITHM = "keyed_hash"
# ---------------------------------------------------------------------------

_TRUE = {"yes", "y", "true", "t", "1"}


def _flag(value: Any) -> bool:
    if isinstance(value, bool):
        return value
    if value is None:
        return False
    return str(value).strip().lower() in _TRUE


def _key(name: str) -> str:
    """Field-name normal form: lower case, no blanks, no underscores."""
    return re.sub(r"[\s_]", "", name).lower()


def _get(doc: dict, *names: str, default: Any = None) -> Any:
    """Look a field up under any of its spellings (case, blanks, '_' ignored)."""
    wanted = {_key(n) for n in names}
    for k, v in doc.items():
        if _key(k) in wanted:
            return v
    return default


def rename_fields(doc: Any, aliases: Mapping[str, str] | None) -> Any:
    """The document with its fields renamed (``their name -> name used here``),
    at every depth; other documents' vocabularies stay with the caller."""
    if not aliases:
        return doc
    names = {_key(k): v for k, v in aliases.items()}
    if isinstance(doc, Mapping):
        return {names.get(_key(k), k): rename_fields(v, aliases) for k, v in doc.items()}
    if isinstance(doc, (list, tuple)):
        return [rename_fields(v, aliases) for v in doc]
    return doc


def normalise_rule(rule: str | None) -> str | None:
    """'<primary_pan_acct_nbr_15>' -> 'primary_pan_acct_nbr15', blanks and
    '-' folded, so that every spelling seen in requests compares equal."""
    if rule is None:
        return None
    r = str(rule).strip().strip("<>").replace(" ", "").replace("-", "_").lower()
    r = re.sub(r"_(15|13|11)$", r"\1", r)
    return r or None


def normalise_name(name: str) -> str:
    """Header normal form used for staged files: lower case, '.' -> '_'."""
    return name.lower().replace(".", "_")


@dataclass(frozen=True)
class NestedAttribute:
    path: str                  # dotted path inside a JSON column, e.g. entities.name
    rule: str | None
    is_pii: bool
    data_type: str = "string"


@dataclass(frozen=True)
class ColumnMeta:
    name: str
    data_type: str = "VARCHAR2"
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    is_pk: bool = False
    is_fk: bool = False
    is_pii: bool = False
    is_nullable: bool = True
    is_encrypted: bool = False
    rule: str | None = None
    algorithm: str | None = None        # e.g. 'deterministic', 'keyed_hash'
    key_name: str | None = None         # per-column key id for E3 / E4
    use_iv: bool = True                 # per-column key: random IV (GCM) or none (ECB)
    nested: tuple[NestedAttribute, ...] = ()

    @property
    def kind(self) -> str:
        return self.data_type.strip().lower()

    @property
    def is_key_hash(self) -> bool:
        return (self.algorithm or "") == KEY_HASH_ALGORITHM

    def spark_type(self) -> T.DataType:
        return spark_type(self.data_type, self.length, self.precision, self.scale)


@dataclass(frozen=True)
class Edge:
    parent_table: str
    child_table: str
    parent_column: str
    child_column: str
    index: int = 0


@dataclass(frozen=True)
class FilterSpec:
    column: str
    condition: str
    values: tuple[str, ...]


@dataclass(frozen=True)
class TableMeta:
    table_name: str
    columns: tuple[ColumnMeta, ...]
    schema_name: str = ""
    request_id: str = ""
    db_type: str = "parquet"
    relational: bool = False
    extract_type: str = "F"
    edges: tuple[Edge, ...] = ()
    driver_table: str | None = None
    driver_column: str | None = None
    driver_rule: str | None = None
    driver_column_encrypted: bool = False
    keys_encrypted: bool = False
    filters: tuple[FilterSpec, ...] = ()
    operator: str = "AND"
    limit: int | None = None
    order: tuple[str, ...] = ()
    partition_column: str | None = None
    partition_range: tuple[str, str] | None = None
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    # -- lookups -----------------------------------------------------------
    def column(self, name: str) -> ColumnMeta:
        for c in self.columns:
            if c.name.lower() == name.lower():
                return c
        raise KeyError(f"{self.table_name}: no column {name!r}")

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @property
    def primary_key(self) -> list[str]:
        return [c.name for c in self.columns if c.is_pk]

    @property
    def has_pii(self) -> bool:
        return any(c.is_pii or any(a.is_pii for a in c.nested) for c in self.columns)

    @property
    def is_own_driver(self) -> bool:
        return self.driver_table is not None and (
            self.driver_table.lower() == self.table_name.lower()
        )

    def struct_type(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c.name, c.spark_type(), c.is_nullable) for c in self.columns]
        )

    def restrict(self, names: list[str]) -> "TableMeta":
        """Same table, only the named columns (in the given order)."""
        return replace(self, columns=tuple(self.column(n) for n in names))

    def edges_by_index(self) -> list[tuple[int, list[Edge]]]:
        groups: dict[int, list[Edge]] = {}
        for e in self.edges:
            groups.setdefault(e.index, []).append(e)
        return sorted(groups.items())

    # -- P3: which PII column keeps its value at extract -------------------
    def highest_priority_rule(self) -> str | None:
        best, best_rank = None, 0
        seen: dict[str, str] = {}
        for c in self.columns:
            if c.rule is None:
                rank, rule = (1, "cust_id") if c.name.lower() == "cust_id" else (0, None)
            else:
                rule = c.rule
                rank = RULE_PRIORITY.get(rule, 0)
            if rank and not c.is_key_hash:
                if rule in seen and seen[rule] != c.name:
                    raise ValueError(
                        f"rule {rule} present for several columns: {seen[rule]}, {c.name}"
                    )
                seen[rule] = c.name
            if rank > best_rank:
                best, best_rank = rule, rank
        return best

    # -- construction ------------------------------------------------------
    @classmethod
    def from_document(cls, doc: dict | str,
                      aliases: Mapping[str, str] | None = None) -> "TableMeta":
        """The request document as metadata; ``aliases`` renames the fields of
        documents that use other names."""
        doc = rename_fields(json.loads(doc) if isinstance(doc, str) else doc, aliases)
        cols = tuple(_column_from(c) for c in (_get(doc, "column_list") or []))
        edges = tuple(
            Edge(
                parent_table=_get(e, "parent_table"),
                child_table=_get(e, "child_table"),
                parent_column=_get(e, "parent_column"),
                child_column=_get(e, "child_column"),
                index=int(_get(e, "index", default=0) or 0),
            )
            for e in (_get(doc, "table_relationship", "table_relationships") or [])
        )
        filters = tuple(
            FilterSpec(
                column=_get(f, "column_name"),
                condition=str(_get(f, "condition")).strip(),
                values=tuple(str(v) for v in (_get(f, "value") or [])),
            )
            for f in (_get(doc, "filter_criteria") or [])
        )
        order = _get(doc, "order")
        prange = _get(doc, "partition_column_range")
        table = _get(doc, "table_name")
        req = str(_get(doc, "table_extract_request_id", default="") or "")
        return cls(
            table_name=table,
            columns=cols,
            schema_name=_get(doc, "schema_name", default="") or "",
            request_id=req,
            db_type=str(_get(doc, "db_type", default="parquet") or "parquet").lower(),
            relational=_flag(_get(doc, "relational_extract")),
            extract_type=str(_get(doc, "extract_type", default="F") or "F").upper(),
            edges=edges,
            driver_table=_get(doc, "driver_table"),
            driver_column=_get(doc, "driver_column"),
            driver_rule=normalise_rule(_get(doc, "driver_column_rule")),
            driver_column_encrypted=_flag(_get(doc, "driver_column_encrypted")),
            keys_encrypted=_flag(_get(doc, "keys_encrypted")),
            filters=filters,
            operator=str(_get(doc, "operator", default="AND") or "AND").upper(),
            limit=_get(doc, "limit"),
            order=tuple(order) if isinstance(order, (list, tuple)) else
            ((order,) if order else ()),
            partition_column=_get(doc, "partition_column"),
            partition_range=tuple(prange) if prange else None,
        )


def _int_or_none(v: Any) -> int | None:
    if v is None or str(v).strip().lower() in ("", "none", "null"):
        return None
    return int(float(v))


def _column_from(c: dict) -> ColumnMeta:
    nested = []
    seen_paths = set()
    for a in _get(c, "complex_column_attributes") or []:
        path = _get(a, "path")
        if not path or path in seen_paths:       # repeated paths occur: keep first
            continue
        seen_paths.add(path)
        nested.append(
            NestedAttribute(
                path=path,
                rule=normalise_rule(_get(a, "rule")),
                is_pii=_flag(_get(a, "isPII", "is_pii")),
                data_type=str(_get(a, "data_type", default="string") or "string"),
            )
        )
    length = _int_or_none(_get(c, "column_length"))
    algorithm = _get(c, "algorithm")
    use_iv = _get(c, "use_iv")
    return ColumnMeta(
        name=_get(c, "column_name"),
        data_type=str(_get(c, "data_type", default="VARCHAR2")),
        length=length if length else None,          # 0 means absent
        precision=_int_or_none(_get(c, "precision")),
        scale=_int_or_none(_get(c, "scale")),
        is_pk=_flag(_get(c, "is_primary_key", "is_primarykey")),
        is_fk=_flag(_get(c, "is_foreign_key")),
        is_pii=_flag(_get(c, "is_pii")),
        is_nullable=_flag(_get(c, "is_nullable", default="YES")),
        is_encrypted=_flag(_get(c, "is_encrypted")),
        rule=normalise_rule(_get(c, "rule")),
        algorithm=str(algorithm).replace(" ", "").lower() if algorithm else None,
        key_name=_get(c, "key_name"),
        use_iv=True if use_iv is None else _flag(use_iv),
        nested=tuple(nested),
    )


# ---------------------------------------------------------------------------
# declared type -> Spark type

_STRING_KINDS = ("varchar", "varchar2", "char", "nchar", "nvarchar2", "string",
                 "character varying", "character", "text", "clob", "nclob", "jsonb",
                 "json", "long")
_BINARY_KINDS = ("blob", "bytea", "raw", "binary", "varbinary")


def spark_type(data_type: str, length: int | None = None, precision: int | None = None,
               scale: int | None = None) -> T.DataType:
    k = data_type.strip().lower()
    if k in _STRING_KINDS:
        return T.StringType()
    if k in _BINARY_KINDS:
        return T.BinaryType()
    if k in ("number", "numeric", "decimal"):
        if precision is None and scale is None:
            return T.DoubleType()
        s = scale or 0
        if s == 0 and (precision or 0) <= 18:
            return T.LongType()
        return T.DecimalType(min(precision or 38, 38), s)
    if k in ("int", "integer", "smallint", "int4", "int2"):
        return T.IntegerType()
    if k in ("bigint", "int8", "long"):
        return T.LongType()
    if k in ("double", "double precision", "float8", "binary_double"):
        return T.DoubleType()
    if k in ("float", "real", "float4", "binary_float"):
        return T.FloatType()
    if k in ("boolean", "bool"):
        return T.BooleanType()
    if k == "date":
        # an Oracle DATE carries a time of day
        return T.TimestampNTZType()
    if k.startswith("timestamp"):
        return T.TimestampType() if "time zone" in k and "local" not in k \
            else T.TimestampNTZType()
    raise ValueError(f"unknown declared type {data_type!r}")
