"""Column expressions for dates, numbers and text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(col: Column, digits: int = 6) -> Column:
    """Round and turn -0.0 into 0.0."""
    return F.round(col, digits) + F.lit(0.0)


def exact_sum(col: Column) -> Column:
    """Sum of amounts of up to six decimals, the same in whatever order the rows come."""
    return F.sum(col.cast("decimal(28,6)")).cast("double")


def ordered_mean(col: Column) -> Column:
    """Mean of the values of a group that fits in a row, added from the smallest up, so that equal groups have equal means."""
    values = F.array_sort(F.collect_list(col.cast("double")))
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda s, x: s + x), F.size(values).cast("double"))


def month_start(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))


def month_key(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def parse_yyyymm(col: Column) -> Column:
    return F.try_to_timestamp(F.concat(col.cast("string"), F.lit("01")), F.lit("yyyyMMdd")).cast("date")


def parse_number(col: Column) -> Column:
    """Text to double, bad text to NULL."""
    return F.trim(col).try_cast("double")


def parse_decimal_comma(col: Column) -> Column:
    return parse_number(F.replace(col, F.lit(","), F.lit(".")))


def parse_date(col: Column, patterns: Sequence[str] = ("dd/MM/yyyy",)) -> Column:
    """First pattern that fits; day first by default; bad text to NULL."""
    # fixed value: suffix some exports leave after the date
    text = F.regexp_replace(F.trim(col), " 00:00:00$", "")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns]).cast("date")


# fixed values: spellings of a missing category in exported text
MISSING_TEXT = ("nan", "<NA>", "None", "")


def clean_category(col: Column) -> Column:
    """Trim, cut one trailing ``.0``, missing spellings to NULL."""
    text = F.regexp_replace(F.trim(col.cast("string")), r"\.0$", "")
    return F.when(~text.isin(*MISSING_TEXT), text)


def safe_log(col: Column) -> Column:
    """Natural logarithm; NULL where it does not exist."""
    return F.when(col > 0, F.ln(col))


def epoch_day(col: Column) -> Column:
    return F.unix_date(col.cast("date"))


def composite_key(names: Sequence[str], separator: str = "||") -> Column:
    """Columns as text, joined; a NULL part reads ``None`` so that keys stay aligned."""
    parts = [F.coalesce(F.col(n).cast("string"), F.lit("None")) for n in names]
    return F.concat_ws(separator, *parts)


def matches_typed_id(col: Column, typed: str | None) -> Column:
    """Filter for an id typed as text; text that is no number filters nothing."""
    wanted = F.trim(F.lit(typed)).try_cast("double")
    return wanted.isNull() | (col.cast("double") == wanted)


def pick_by_match(final: Column, new: Column, if_new: Column, otherwise: Column) -> Column:
    """``if_new`` where the final label came from the new source."""
    return F.when(final == new, if_new).otherwise(otherwise)
