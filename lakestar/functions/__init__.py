from .columns import (
    SKEY_SUFFIX,
    changed,
    changed_sql,
    clean_id,
    clean_label,
    clean_lower,
    clean_title,
    in_range,
    money,
    pack,
    parse_day,
    parse_timestamp,
    skey_name,
    surrogate_key,
    text_literal,
    to_float,
    to_int,
    to_money,
    unpack,
)

__all__ = [
    "SKEY_SUFFIX",
    "changed",
    "changed_sql",
    "clean_id",
    "clean_label",
    "clean_lower",
    "clean_title",
    "in_range",
    "money",
    "pack",
    "parse_day",
    "parse_timestamp",
    "skey_name",
    "surrogate_key",
    "text_literal",
    "to_float",
    "to_int",
    "to_money",
    "unpack",
]
