"""Type-2 history: the rows that bring a dimension from its stored state to a new source state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import SKEY_SUFFIX, changed_sql, skey_name, text_literal
from ..specs import DimensionSpec
from .upsert import upsert

# Fixed value: end date of a version that is still open.
OPEN_END = dt.date(9999, 12, 31)
DEFAULT_ACTOR = "lakestar_elt"


def is_open() -> Column:
    return (F.col("eff_end_dt") == F.lit(OPEN_END)) & (F.col("is_current") == 1)


def current(dim: DataFrame) -> DataFrame:
    """Versions in force; both predicates reach the partition filter of a stored dimension."""
    return dim.filter(is_open())


# The rows below are SQL text: a wide dimension is one list of expressions for the driver to parse
# instead of several calls per column and row kind.


def _typed(spec: DimensionSpec, values: dict[str, str]) -> dict[str, str]:
    return {f.name: f"CAST({values[f.name]} AS {f.dataType.simpleString()})" for f in spec.schema}


def _opened(as_of: dt.date, actor: str) -> dict[str, str]:
    return {
        "eff_start_dt": f"DATE'{as_of}'",
        "eff_end_dt": f"DATE'{OPEN_END}'",
        "is_current": "1",
        "insert_date": f"DATE'{as_of}'",
        "inserted_by": text_literal(actor),
        "update_date": "NULL",
        "updated_by": "NULL",
    }


def _new_row(spec: DimensionSpec, as_of: dt.date, actor: str) -> dict[str, str]:
    """A key the dimension has never held: surrogate keys are made here and never change."""
    ids = {k: f"src.{k}" for k in spec.keys}
    skeys = {skey_name(k): f"concat(src.{k}, '{SKEY_SUFFIX}')" for k in spec.keys}
    attrs = {a: f"src.{a}" for a in spec.attributes}
    return _typed(spec, ids | skeys | attrs | _opened(as_of, actor))


def _active_row(spec: DimensionSpec, as_of: dt.date, actor: str) -> dict[str, str]:
    """The version that starts now: identity of the stored row, attributes of the source."""
    stored = {c: f"tgt.{c}" for c in spec.identity}
    attrs = {a: f"src.{a}" for a in spec.attributes}
    return _typed(spec, stored | attrs | _opened(as_of, actor))


def _closed_row(spec: DimensionSpec, as_of: dt.date, actor: str) -> dict[str, str]:
    """The stored version, ended on the day before."""
    stored = {name: f"tgt.{name}" for name in spec.schema.names}
    closing = {
        "eff_end_dt": f"DATE'{as_of - dt.timedelta(days=1)}'",
        "is_current": "0",
        "update_date": f"DATE'{as_of}'",
        "updated_by": text_literal(actor),
    }
    return _typed(spec, stored | closing)


def _same_business_key(spec: DimensionSpec) -> Column:
    return F.expr(" AND ".join(f"src.{k} = tgt.{k}" for k in spec.keys))


def _is_newer_and_different(spec: DimensionSpec, as_of: dt.date) -> str:
    """A change counts only when it is dated after the stored version began, and only in a run dated
    after that: a back-dated run would close a version before it began."""
    schema = spec.schema
    differs = [changed_sql(f"tgt.{a}", f"src.{a}", schema[a].dataType) for a in spec.attributes]
    dated = f"src.last_update_date > tgt.eff_start_dt AND tgt.eff_start_dt < DATE'{as_of}'"
    return f"{dated} AND ({' OR '.join(differs)})"


def _hits(src: DataFrame, tgt: DataFrame, spec: DimensionSpec, as_of: dt.date) -> DataFrame:
    joined = src.alias("src").join(current(tgt).alias("tgt"), _same_business_key(spec), "inner")
    return joined.filter(_is_newer_and_different(spec, as_of))


def _as_columns(df: DataFrame, row: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{value} AS {name}" for name, value in row.items()])


def scd2_new(
    src: DataFrame, tgt: DataFrame, spec: DimensionSpec, as_of: dt.date, actor: str = DEFAULT_ACTOR
) -> DataFrame:
    """Source keys without any version, open or closed."""
    known = tgt.select(*spec.keys).alias("tgt")
    unknown = src.alias("src").join(known, _same_business_key(spec), "left_anti")
    return _as_columns(unknown, _new_row(spec, as_of, actor))


def scd2_active(
    src: DataFrame, tgt: DataFrame, spec: DimensionSpec, as_of: dt.date, actor: str = DEFAULT_ACTOR
) -> DataFrame:
    return _as_columns(_hits(src, tgt, spec, as_of), _active_row(spec, as_of, actor))


def scd2_inactive(
    src: DataFrame, tgt: DataFrame, spec: DimensionSpec, as_of: dt.date, actor: str = DEFAULT_ACTOR
) -> DataFrame:
    return _as_columns(_hits(src, tgt, spec, as_of), _closed_row(spec, as_of, actor))


def scd2_changes(
    src: DataFrame,
    tgt: DataFrame,
    spec: DimensionSpec,
    as_of: dt.date,
    actor: str = DEFAULT_ACTOR,
    every_key_open: bool = False,
) -> DataFrame:
    """New, active and closed rows in one pass: one join, each side read and shuffled once.

    The stored side is the open versions in full plus the bare keys of the closed ones, which only
    tell a new key from a retired one. A dimension kept by this module has an open version for
    every key it knows, so ``every_key_open=True`` leaves the history unread.

    Both join inputs come straight from a shuffle, so adaptive execution can split a hot key. The business
    key of a change is that of the source row, so what is dealt by it stays dealt by it.
    """
    known = current(tgt).selectExpr(*spec.schema.names, "true AS is_open")
    if not every_key_open:
        is_closed = ~F.coalesce(is_open(), F.lit(False))
        bare_keys = [
            f.name if f.name in spec.keys else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
            for f in spec.schema
        ]
        known = known.unionByName(tgt.filter(is_closed).selectExpr(*bare_keys, "false AS is_open"))
    joined = src.alias("src").join(known.alias("tgt"), _same_business_key(spec), "left_outer")

    is_new = "tgt.is_open IS NULL"
    is_hit = f"coalesce(tgt.is_open AND {_is_newer_and_different(spec, as_of)}, false)"
    kinds = f"explode(CASE WHEN {is_new} THEN array('new') ELSE array('active', 'closed') END) AS _kind"
    rows = joined.filter(f"{is_new} OR {is_hit}").selectExpr("src.*", "tgt.*", kinds)
    new, active, closed = (make(spec, as_of, actor) for make in (_new_row, _active_row, _closed_row))

    def either(c: str) -> str:
        if c in spec.keys:
            return f"src.{c}"
        cases = f"CASE _kind WHEN 'new' THEN {new[c]} WHEN 'active' THEN {active[c]} ELSE {closed[c]} END"
        return cases if len({new[c], active[c], closed[c]}) > 1 else new[c]

    return _as_columns(rows, {c: either(c) for c in spec.schema.names})


def scd2_apply(dim: DataFrame, changes: DataFrame, spec: DimensionSpec) -> DataFrame:
    """The dimension after the change set.

    The record key holds the end date: an active row replaces the open row of its key, and a
    closed row joins the history. Changes are made from the dimension, so both may be dealt by the business
    key already, and then neither is shuffled here.
    """
    return upsert(dim, changes, spec.record_key, order_col="eff_start_dt", together=True)
