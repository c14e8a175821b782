"""Similarities of strings and vectors as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(text: Column) -> Column:
    """Distinct 3-grams of the words, each padded by two blanks before and one after."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    grams = F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substr(w, i, F.lit(3))))
    return F.array_distinct(F.flatten(grams))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared 3-grams over all 3-grams, 0 if there are none."""
    ta, tb = trigrams(a), trigrams(b)
    union = F.size(F.array_union(ta, tb))
    return F.when(union > 0, F.size(F.array_intersect(ta, tb)) / union).otherwise(0.0)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    return 1 - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
