"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnspark.settings import EVENT_EPOCH_SECONDS

# The components of the derived entity id, in order.
ENTITY_COMPONENTS = ("card1", "card2", "card3", "card4", "card5", "card6", "addr1", "addr2")
# Text forms of a missing component.
MISSING_TEXT = ("NaN", "nan", "None", "null")


def present(df: DataFrame, name: str) -> bool:
    """Whether ``df`` has a column of exactly this name."""
    return name in df.columns


def text_or_null(df: DataFrame, name: str, length: int) -> Column:
    """The column as text of at most ``length`` characters; NULL text if absent."""
    if not present(df, name):
        return F.lit(None).cast("string")
    return F.substring(F.col(name).cast("string"), 1, length)


def number_or_null(df: DataFrame, name: str, kind: str = "double") -> Column:
    """The column as a number; NULL where absent or not a number."""
    if not present(df, name):
        return F.lit(None).cast(kind)
    return to_number(df, name, kind)


def to_number(df: DataFrame, name: str, kind: str = "double") -> Column:
    """Coerce to a number: unparsable text and NaN become NULL."""
    column, nothing = F.col(name), F.lit(None).cast("double")
    source = df.schema[name].dataType
    if isinstance(source, T.BooleanType):
        column = column.cast("int")
    if isinstance(source, (T.DoubleType, T.FloatType)):
        return F.nanvl(column, nothing).try_cast(kind)
    if kind in ("double", "float"):
        return F.nanvl(column.try_cast("double"), nothing).cast(kind) if isinstance(source, T.StringType) else column.try_cast(kind)
    if isinstance(source, T.StringType):
        column = F.nanvl(column.try_cast("double"), nothing)
    return column.try_cast(kind)


def entity_id(
    df: DataFrame, components: Sequence[str] = ENTITY_COMPONENTS, *, canonical: bool = False
) -> Column:
    """MD5 of the components' text forms joined by ``_``; missing ones count as empty.

    Never NULL: rows without any component share one id.  The text form follows the
    column type (``13926`` or ``13926.0``); ``canonical`` drops the fraction of
    integral numbers so that the id does not depend on how a file was typed.
    """
    parts = []
    for name in components:
        if not present(df, name):
            parts.append(F.lit(""))
            continue
        text = F.col(name).cast("string")
        if canonical and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            whole = F.col(name).try_cast("bigint")
            text = F.when(whole.cast("double") == F.col(name), whole.cast("string")).otherwise(text)
        parts.append(F.when(text.isin(*MISSING_TEXT), F.lit("")).otherwise(F.coalesce(text, F.lit(""))))
    return F.md5(F.concat_ws("_", *parts))


def event_time(offset_seconds: Column, epoch_seconds: int = EVENT_EPOCH_SECONDS) -> Column:
    """Timestamp ``offset_seconds`` after the epoch; NULL stays NULL."""
    return F.timestamp_seconds(F.lit(epoch_seconds) + offset_seconds.cast("bigint"))


def event_day(at: Column) -> Column:
    """Midnight of the day."""
    return F.date_trunc("day", at)


def log_amount(amount: Column) -> Column:
    """log(1 + amount)."""
    return F.log1p(amount)


def blank_as_null(column: Column, *, all_whitespace: bool = False) -> Column:
    """NULL for text that is empty or only spaces (optionally any whitespace)."""
    left_over = F.regexp_replace(column, r"\s+", "") if all_whitespace else F.trim(column)
    return F.when(left_over != "", column)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN for floating-point columns."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def any_present(df: DataFrame, names: Sequence[str]) -> Column:
    """Whether any of the named columns that exist is not NULL; false if none exists."""
    found = [F.col(n).isNotNull() for n in names if present(df, n)]
    result = F.lit(False)
    for condition in found:
        result = result | condition
    return result
