"""Preprocessing of text columns and the vector extractor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim(value: Column) -> Column:
    return F.trim(value.cast("string"))


def case_normalize(value: Column) -> Column:
    return F.lower(value.cast("string"))


def stop_words(value: Column, pattern: str) -> Column:
    """All matches of the pattern deleted; null stays null."""
    return F.regexp_replace(value.cast("string"), pattern, "")


def vector_value(value: Column) -> Column:
    """Coordinate 1 of a vector struct (type, size, indices, values): 0.0 where a sparse one does not list it."""
    listed = F.coalesce(F.array_position(value["indices"], F.lit(1)), F.lit(0)).cast("int")
    sparse = F.coalesce(F.get(value["values"], listed - 1), F.lit(0.0))
    return F.when(value.isNotNull(), F.when(value["type"] == 0, sparse).otherwise(F.get(value["values"], F.lit(1))))


PREPROCESS = {"trim": trim, "caseNormalize": case_normalize, "stopWords": stop_words}
