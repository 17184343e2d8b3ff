"""Small scalar functions: object paths, keys, quantisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NODATA = -128


def bucket(uri: Column) -> Column:
    """The bucket of an ``s3://`` address; null if it is none, or has no key part."""
    found = F.regexp_extract(uri, r"^s3://([^/]*)/", 1)
    return F.when(uri.rlike(r"^s3://[^/]*/"), found)


def object_key(uri: Column) -> Column:
    return F.when(uri.rlike(r"^s3://[^/]*/"), F.regexp_extract(uri, r"^s3://[^/]*/(.*)$", 1))


def object_path(uri: Column) -> Column:
    """Where to read: the key of an ``s3://`` address (null if malformed), any other path as it is."""
    return F.when(uri.startswith("s3://"), object_key(uri)).otherwise(uri)


def chunk_key(time_idx: Column, row_idx: Column, col_idx: Column) -> Column:
    return F.concat_ws(":", time_idx, row_idx, col_idx)


def quantise(v: Column) -> Column:
    """A float as a signed square root on -127..127."""
    scaled = F.round(F.sqrt(F.abs(v)) * F.signum(v) * 127.5)
    return F.least(F.greatest(scaled, F.lit(-127.0)), F.lit(127.0)).cast("int")


def dequantise(q: Column) -> Column:
    """The float of a quantised value; null for nodata."""
    return F.when(q != NODATA, F.pow(q / F.lit(127.5), F.lit(2.0)) * F.signum(q.cast("double")))
