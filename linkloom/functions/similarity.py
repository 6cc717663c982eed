"""Pairwise similarities as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact(a: Column, b: Column) -> Column:
    return (F.trim(a) == F.trim(b)).cast("double")


def _tokens(a: Column) -> Column:
    return F.array_distinct(F.filter(F.split(a, " "), lambda t: t != ""))


def token_jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct tokens; 1 for two empty strings."""
    shared, both = F.size(F.array_intersect(_tokens(a), _tokens(b))), F.size(F.array_union(_tokens(a), _tokens(b)))
    return F.when(both == 0, 1.0).otherwise(shared / F.greatest(both, F.lit(1)))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix over the longer length; 1 for two empty strings."""
    most, least = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    agree = F.filter(F.sequence(F.lit(0), least), lambda i: F.left(a, i) == F.left(b, i))
    return F.when(most == 0, 1.0).otherwise(F.array_max(agree) / F.greatest(most, F.lit(1)))


def length_ratio(a: Column, b: Column) -> Column:
    most, least = F.greatest(F.length(a), F.length(b)), F.least(F.length(a), F.length(b))
    return F.when(most == 0, 1.0).otherwise(least / F.greatest(most, F.lit(1)))


def street_agreement(a: Column, b: Column) -> Column:
    """0.5 if either number is missing, else whether they are equal."""
    a, b = F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))
    return F.when((a == "") | (b == ""), 0.5).when(a == b, 1.0).otherwise(0.0)


def flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def missing(a: Column, b: Column) -> Column:
    return flag((F.trim(a) == "") | (F.trim(b) == ""))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of numbers; 0 if either is zero."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm == 0, 0.0).otherwise(dot(a, b) / F.when(norm == 0, 1.0).otherwise(norm))
