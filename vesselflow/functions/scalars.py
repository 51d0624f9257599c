"""Lenient casts of vendor values, identities and time buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_text(x: Column) -> Column:
    """Trimmed text; null where nothing is left."""
    return F.nullif(F.trim(x.cast("string")), F.lit(""))


def to_number(x: Column) -> Column:
    return F.trim(x.cast("string")).try_cast("double")


def to_whole(x: Column) -> Column:
    """Through a double, towards zero: '5.9' is 5."""
    return to_number(x).try_cast("int")


def to_strict_whole(x: Column) -> Column:
    """Digits with an optional sign only: '5.5' is null."""
    t = F.trim(x.cast("string"))
    return F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("int"))


def for_hash(x: Column) -> Column:
    """Upper-case trimmed text; '' for nulls and the words nan, none, null."""
    t = F.trim(F.coalesce(x.cast("string"), F.lit("")))
    return F.when(F.lower(t).isin("nan", "none", "null"), F.lit("")).otherwise(F.upper(t))


def bucket(ts: Column, minutes: int) -> Column:
    """Start of the ts's bucket, UTC-aligned."""
    us = minutes * 60_000_000
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(us))).cast("timestamp_ntz")


def day(ts: Column) -> Column:
    return bucket(ts, 1440)


def seconds_between(a: Column, b: Column) -> Column:
    """b - a in seconds."""
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 1e6
