"""Column functions: every one is a Spark expression, so plans stay inside code generation.

Casts never raise: a value that cannot be read becomes NULL and is then caught
by the validation rules, whatever the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: calendar names are blank-padded to this width in the date dimension.
NAME_WIDTH = 9


def clean(text: Column) -> Column:
    """Strip surrounding spaces (tabs and line breaks stay)."""
    return F.trim(text)


def title(text: Column) -> Column:
    """Stripped, each space-separated word capitalised and the rest lower-cased."""
    return F.initcap(F.trim(text))


def code(text: Column) -> Column:
    """Stripped and upper-cased."""
    return F.upper(F.trim(text))


def whole_number(text: Column) -> Column:
    """Text to int, cutting decimals off: ``2.7`` gives 2, ``abc`` and out-of-range give NULL.

    Everything goes through double: that reads decimals and exponents, holds
    every int exactly, and a failing string-to-int cast costs an exception per
    row. A trailing ``d`` or ``f``, which Spark's double parser accepts as a
    suffix, is not a number here.
    """
    last = F.substring(F.rtrim(text), -1, 1)
    return F.when(~last.isin("d", "D", "f", "F"), text.try_cast("double").try_cast("int"))


def money(text: Column) -> Column:
    """Text to double, NULL when unreadable."""
    return text.try_cast("double")


def parse_instant(text: Column) -> Column:
    """ISO-8601 text, with or without offset and fraction, to a timestamp; NULL when unreadable."""
    return F.try_to_timestamp(text)


def surrogate_key(natural_key: Column) -> Column:
    """32 hex characters identifying a natural key; NULL stays NULL."""
    return F.md5(natural_key)


# Before the bytes of a key that is no digest: with it they are longer than one.
_TEXT_FOLLOWS = bytes(17)


def packed_key(key: Column) -> Column:
    """A text key as bytes: 16 for a surrogate key, else the text behind zero bytes. Different keys differ; NULL stays NULL."""
    digest = F.unhex(key)
    longer = F.concat(F.lit(_TEXT_FOLLOWS), key.cast("binary"))
    return F.when((F.octet_length(key) == 32) & (F.lower(F.hex(digest)) == key), digest).otherwise(longer)


def unpacked_key(packed: Column) -> Column:
    """The text of a ``packed_key``."""
    text = F.substr(packed, F.lit(len(_TEXT_FOLLOWS) + 1)).cast("string")
    return F.when(F.octet_length(packed) == 16, F.lower(F.hex(packed))).otherwise(text)


def date_key(instant: Column) -> Column:
    """Integer YYYYMMDD of the instant's day."""
    return (F.year(instant) * 10000 + F.month(instant) * 100 + F.dayofmonth(instant)).cast("int")


def line_total(unit_price: Column, quantity: Column) -> Column:
    """What a line should cost, to two decimals."""
    return F.round(unit_price * quantity, 2)


def cents(amount: Column) -> Column:
    """Amount as a whole number of cents."""
    return F.round(amount * 100, 0).try_cast("bigint")


def serving_money(amount: Column) -> Column:
    """Amount as DECIMAL(10,2), rounded half up; NULL when it does not fit."""
    return F.round(amount, 2).try_cast("decimal(10,2)")


def padded_month_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "MMMM"), NAME_WIDTH, " ")


def padded_day_name(day: Column) -> Column:
    return F.rpad(F.date_format(day, "EEEE"), NAME_WIDTH, " ")


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters read instead of recomputing.

    Spark pushes a filter below a projection by copying the column's expression
    into the filter, once per mention. It does not do so below a generator, so
    the value comes out of a one-element ``inline``. Use it for columns that are
    both filtered on and expensive; other filters still move down past it.
    """
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))
