"""Dates of updates in page text, and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V


def parse_date(text: Column) -> Column:
    """The first date in a text in normal form, in years of an era or of the Western calendar; null if there is no such day."""
    part = lambda i: F.nullif(F.regexp_extract(text, V.DATE_PARTS, i), F.lit(""))
    offset = F.coalesce(*[F.when(part(1) == era, years) for era, years in V.ERAS.items()])
    year = F.when(part(1).isNotNull(), offset + F.when(part(2) == "元", 1).otherwise(part(2).cast("int"))).otherwise(part(3).cast("int"))
    return F.try_to_date(F.format_string("%04d-%02d-%02d", year, part(4).cast("int"), part(5).cast("int")), "yyyy-MM-dd")


def updated_on(page_text: Column) -> Column:
    """The first real date beside a word for an update, else beside one for a publication."""

    def first(pattern: str) -> Column:
        found = F.transform(F.regexp_extract_all(page_text, F.lit(pattern), F.lit(0)), parse_date)
        return F.get(F.filter(found, lambda d: d.isNotNull()), F.lit(0))

    return F.coalesce(first(V.UPDATED), first(V.PUBLISHED))


def jst_minutes(ts: Column) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, "Asia/Tokyo"), "yyyy-MM-dd HH:mm")


def seconds_between(a: Column, b: Column) -> Column:
    """Whole seconds from b to a, rounded."""
    return F.round((F.unix_micros(a) - F.unix_micros(b)) / 1e6).cast("long")
