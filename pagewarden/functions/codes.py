"""Codes, psids, areas and ages of registry rows, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\p{Z}]"


def trim(c: Column) -> Column:
    """Unicode white space off both ends."""
    return F.regexp_replace(c, rf"^{_SPACE}+|{_SPACE}+$", "")


def normalize_codes(codes: Column) -> Column:
    """Codes split at commas of three kinds, trimmed, digits padded to three places, empty ones dropped, each once in order."""
    parts = F.flatten(F.transform(F.coalesce(codes, F.array().cast("array<string>")), lambda v: F.split(F.coalesce(v, F.lit("")), "[,，、]")))
    parts = F.filter(F.transform(parts, trim), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]{1,2}$"), F.lpad(p, 3, "0")).otherwise(p)))


def unknown_codes(codes: Column, known: list[str]) -> Column:
    """Codes outside a vocabulary, in order and with repeats."""
    return F.filter(codes, lambda c: ~c.isin(*known))


def um_from_psid(psid: Column) -> Column:
    """The last '+'-separated part if it is UM and digits, else null."""
    return F.nullif(F.regexp_extract(psid, r"(?:^|\+)(UM[0-9]+)\z", 1), F.lit(""))


def split_area(value: Column) -> Column:
    """struct(code, name) of 'code;name', null unless the code has six digits and the name is not empty."""
    at = F.instr(value, ";")
    code, name = trim(F.substring(value, F.lit(1), at - 1)), trim(F.substring(value, at + 1, F.length(value)))
    return F.when((at > 0) & code.rlike("^[0-9]{6}$") & (name != ""), F.struct(code.alias("code"), name.alias("name")))


def total_months(years: Column, months: Column) -> Column:
    return F.when(years.isNotNull() | months.isNotNull(), F.coalesce(years, F.lit(0)) * 12 + F.coalesce(months, F.lit(0)))


def age_min_months(at_least: Column, over: Column) -> Column:
    """Least lower bound that is given; both kinds count as inclusive. Arguments are month counts."""
    return F.least(at_least, over)


def age_max_months(less_than: Column, at_most_years: Column, at_most_months: Column) -> Column:
    """Exclusive upper bound: '<' as it is; '<=' of years alone reaches to the next birthday, with months to the next month."""
    inclusive = F.when(at_most_months.isNotNull(), total_months(at_most_years, at_most_months) + 1).otherwise((at_most_years + 1) * 12)
    top = F.greatest(less_than, inclusive)
    return F.when(top > 0, top)


def age_matches(month: Column | int, low: Column, high: Column) -> Column:
    """Half-open range; a null bound is open."""
    m = F.lit(month) if isinstance(month, int) else month
    return (low.isNull() | (low <= m)) & (high.isNull() | (high > m))
