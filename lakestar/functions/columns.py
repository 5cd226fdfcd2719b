"""Column builders shared by the layers.

Every function takes and returns a ``Column`` made of built-in expressions, so all of it stays
inside whole-stage code generation, and none of it can raise under ANSI mode: malformed input
becomes null.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

SKEY_SUFFIX = "_skey"

# Amounts are summed as decimals so that a total does not depend on the order in which the
# partial sums of the tasks arrive; ten fractional digits keep sub-cent inputs exact.
MONEY_TYPE = "decimal(28,10)"


def clean_id(c: Column) -> Column:
    return F.upper(F.trim(c))


def clean_lower(c: Column) -> Column:
    return F.lower(F.trim(c))


def clean_title(c: Column) -> Column:
    return F.initcap(F.trim(c))


def clean_label(c: Column) -> Column:
    """Codes such as ``credit_card`` to words such as ``Credit Card``."""
    return F.initcap(F.trim(F.translate(c, "_", " ")))


def parse_timestamp(fmt: str) -> Callable[[Column], Column]:
    return lambda c: F.try_to_timestamp(c, F.lit(fmt))


def parse_day(fmt: str) -> Callable[[Column], Column]:
    return lambda c: F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def to_int(c: Column) -> Column:
    """Integer from text; goes through double so that ``'3.0'`` gives 3."""
    return c.try_cast("double").try_cast("int")


def to_float(c: Column) -> Column:
    return c.try_cast("float")


def to_money(c: Column) -> Column:
    return c.try_cast(MONEY_TYPE)


def money(total: Column) -> Column:
    """A decimal total as a double rounded to cents."""
    return F.round(total, 2).cast("double")


def in_range(c: Column, low: float, high: float) -> Column:
    """Inclusive range test on text; text that is no number does not pass."""
    return F.coalesce(c.try_cast("double").between(low, high), F.lit(False))


# Text columns on their way through a shuffle. The first character ends a value; the second one escapes both in a
# value, which keeps their order, and alone it is an empty text, so that a null comes before that.
_END, _ESCAPE, _NEXT = "\x00", "\x01", "\x02"


def pack(columns: Sequence[str]) -> Column:
    """Text columns as one text, which ``unpack`` takes apart again and which sorts as they do, nulls first.

    A shuffled or sorted row holds eight bytes for each column and fills each text up to eight; as one text, a
    wide row of short texts takes half the space or less.
    """

    def part(c: Column) -> Column:
        plain = F.replace(c, F.lit(_ESCAPE), F.lit(_ESCAPE + _NEXT))
        plain = F.replace(plain, F.lit(_END), F.lit(_ESCAPE + _ESCAPE))
        return F.when(c.isNull(), "").when(c == "", _ESCAPE).otherwise(plain)

    return F.concat_ws(_END, *[part(F.col(c)) for c in columns])


def unpack(packed: Column, columns: Sequence[str]) -> dict[str, Column]:
    """The columns that ``pack`` was given."""

    def cut(i: int) -> Column:  # byte by byte, for bytes that are no text and would not outlast the split
        return F.substring_index(F.substring_index(packed, _END, i + 1), _END, -1)

    parts = F.when(F.is_valid_utf8(packed), F.split(packed, _END)).otherwise(
        F.array(*[cut(i) for i in range(len(columns))])
    )

    def value(part: Column) -> Column:
        plain = F.replace(part, F.lit(_ESCAPE + _ESCAPE), F.lit(_END))
        plain = F.replace(plain, F.lit(_ESCAPE + _NEXT), F.lit(_ESCAPE))
        return F.when(part == _ESCAPE, "").when(part != "", plain)

    return {c: value(parts[i]) for i, c in enumerate(columns)}


def surrogate_key(c: Column) -> Column:
    return F.concat(c, F.lit(SKEY_SUFFIX))


def skey_name(id_column: str) -> str:
    return id_column.removesuffix("_id") + SKEY_SUFFIX


def changed_sql(old: str, new: str, dtype: DataType) -> str:
    """SQL test whether an attribute differs, never null.

    For strings a null and an empty string are the same value; every other type compares
    null-safely in its own type.
    """
    if isinstance(dtype, StringType):
        return f"coalesce({old}, '') <> coalesce({new}, '')"
    return f"NOT ({old} <=> {new})"


def changed(old: str, new: str, dtype: DataType) -> Column:
    return F.expr(changed_sql(old, new, dtype))


def text_literal(value: str) -> str:
    """A string as a SQL literal."""
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
