"""Column expressions: parsing, recoding, flags, dates, ratios, formats."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def numeric_cols(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_cols(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def parse_dmy(col: Column) -> Column:
    """``%d-%b-%y`` text to date. Two-digit years 69..99 belong to 19xx, 00..68 to 20xx."""
    parsed = F.to_date(F.try_to_timestamp(F.trim(col), F.lit("d-MMM-yy")))
    return F.when(F.year(parsed) >= 2069, F.add_months(parsed, -1200)).otherwise(parsed)


def parse_money(col: Column) -> Column:
    """``$1,234.00 `` to double; null where the rest is not a number."""
    return F.regexp_replace(col, "[$,]", "").try_cast("double")


def parse_year(col: Column, fixes: Mapping[str, int] | None = None) -> Column:
    """Text year to int after replacing known bad literals."""
    value = col.cast("string")
    for bad, good in (fixes or {}).items():
        value = F.when(value == bad, F.lit(str(good))).otherwise(value)
    return value.try_cast("int")


def code_prefix(col: Column, n: int = 2) -> Column:
    return F.substring(col.cast("string"), 1, n)


def recode(col: Column, mapping: Mapping, default: Column | None = None) -> Column:
    """Value map; values without an entry become ``default`` (null if not given)."""
    table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    value = F.try_element_at(table, col)
    return value if default is None else F.coalesce(value, default)


def flag_ge(col: Column, threshold) -> Column:
    return F.when(col >= threshold, 1).otherwise(0)


def flag_pos(col: Column) -> Column:
    """1 for positive values, otherwise the value itself (a negative one stays)."""
    return F.when(col > 0, F.lit(1).cast("long")).otherwise(col)


def flag_eq(a: Column, b: Column) -> Column:
    """1 when equal; 0 when different or when either side is null."""
    return F.when(a == b, 1).otherwise(0)


def has_franchise(code: Column, treat_one_as_none: bool = False) -> Column:
    """1 for any non-zero code; optionally code 1 counts as no franchise too."""
    yes = (code != 0) & (code != 1) if treat_one_as_none else code != 0
    return F.when(yes, 1).otherwise(0)


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, null when b is zero."""
    return F.try_divide(a, b)


def days_between(start: Column, end: Column) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(end, start)


def add_term_days(day: Column, months: Column, days_per_month: int = 30) -> Column:
    return F.date_add(day, (months * days_per_month).cast("int"))


def in_closed_interval(day: Column, lo: str, hi: str) -> Column:
    """1 when the date lies in [lo, hi], else 0."""
    return F.when(day.cast("date").between(F.lit(lo).cast("date"), F.lit(hi).cast("date")), 1).otherwise(0)


def date_parts(day: Column) -> dict[str, Column]:
    return {
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": F.date_format(day, "EEEE"),
    }


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def hhmm(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm")


def title_case(col: Column, fixes: Mapping[str, str] | None = None) -> Column:
    """Capitalise each word, then replace listed results."""
    titled = F.initcap(F.lower(col))
    return recode(titled, fixes, default=titled) if fixes else titled


def fmt_mean_std(mean: Column, std: Column, digits: int = 4) -> Column:
    """``mean ± std`` as text with a fixed number of decimals; null where either is null."""
    pattern = f"%.{digits}f"
    return F.when(mean.isNotNull() & std.isNotNull(), F.concat(F.format_string(pattern, mean), F.lit(" ± "), F.format_string(pattern, std)))


def cap_std(mean: Column, std: Column, strict: bool = False) -> Column:
    """0.99 * |mean| where the spread reaches (or, if strict, exceeds) the mean; else the spread."""
    over = F.abs(std) > F.abs(mean) if strict else F.abs(std) >= F.abs(mean)
    return F.when(over, F.lit(0.99) * F.abs(mean)).otherwise(std)


def scale_units(col: Column, divisor: float = 1e6) -> Column:
    """ns to ms, or bytes to MB."""
    return col / F.lit(divisor)


def log_columns(df: DataFrame, cols: Sequence[str], suffix: str = "") -> DataFrame:
    """Natural log of the given columns (log of 0 is null)."""
    return df.withColumns({f"{c}{suffix}": F.ln(c) for c in cols})
