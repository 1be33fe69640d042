"""Names: Unicode normal form, comparison form, and similarity."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import vocab as V


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Spark has no normal forms; the rest of the name work stays in the JVM."""
    return text.map(lambda t: unicodedata.normalize("NFKC", t) if isinstance(t, str) else None)


def letters(text: Column) -> Column:
    """Lower-case letters and digits only, of text in normal form."""
    return F.regexp_replace(F.lower(text), r"[^\p{IsAlphabetic}\p{N}]", "")


def normalize_name(text: Column) -> Column:
    return letters(F.when(text.rlike(r"^[\x00-\x7F]*$"), text).otherwise(nfkc(text)))


def one_line(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\s\p{Z}]+", " "))


def bigrams(name: Column) -> Column:
    """Adjacent pairs of code points; of a name of two or more."""
    return F.when(F.char_length(name) >= 2, F.transform(F.sequence(F.lit(1), F.char_length(name) - 1), lambda i: F.substring(name, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def numbered(pairs: Column) -> Column:
    """Each entry with how often it came before, so that sets of these intersect as multisets do."""
    times = lambda x, i: F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda y: y == x))
    return F.transform(pairs, lambda x, i: F.concat(x, times(x, i).cast("string")))


def features(name: Column) -> Column:
    """What similar() compares of a normalised name; made once for a row, before rows are paired."""
    return F.struct(name.alias("name"), F.char_length(name).alias("length"), numbered(bigrams(name)).alias("pairs"))


def similar(a: Column, b: Column, least: float = 0.0) -> Column:
    """0 under four characters; 1 if the longer contains the shorter and is at most twice as long; else Dice over bigrams
    with their multiplicities. Arguments are features(). Where the lengths alone keep Dice under ``least`` it is 0."""
    la, lb = a["length"], b["length"]
    ga, gb = F.size(a["pairs"]), F.size(b["pairs"])
    within = F.when(la <= lb, F.contains(b["name"], a["name"])).otherwise(F.contains(a["name"], b["name"]))
    short, half = (la < V.MIN_NAME_CHARS) | (lb < V.MIN_NAME_CHARS), 2 * F.least(la, lb) >= F.greatest(la, lb)
    dice = (2.0 * F.size(F.array_intersect(a["pairs"], b["pairs"]))) / (ga + gb)
    out = F.when(short, F.lit(0.0)).when(half & within, F.lit(1.0))
    return out.when(2.0 * F.least(ga, gb) < least * (ga + gb), F.lit(0.0)).otherwise(dice)


def similarity(a: Column, b: Column) -> Column:
    """similar() of two normalised names."""
    return similar(features(a), features(b))
