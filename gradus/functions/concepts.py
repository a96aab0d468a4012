"""Concept sets as sorted arrays, and their 0/1 form."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradus.functions.folding import let
from gradus.functions.labels import lookup
from gradus.functions.text import concept_key
from gradus.schema import CONCEPTS


def one_hot(names: Column, taxonomy: list[str] = CONCEPTS) -> Column:
    """Raw names to a 0/1 array over the taxonomy; unknown names are dropped."""
    keys = F.transform(F.coalesce(names, F.array().cast("array<string>")), concept_key)
    return let(
        keys,
        lambda known: F.array(
            *[F.array_contains(known, F.lit(c)).cast("int") for c in taxonomy]
        ),
    )


def concept_set(flags: Column, taxonomy: list[str] = CONCEPTS) -> Column:
    """The 0/1 array back to a sorted array of names; a NULL flag counts as 0."""
    named = F.array(
        *[F.when(flags[i] == 1, F.lit(name)) for i, name in enumerate(taxonomy)]
    )
    return F.array_sort(F.array_compact(named))


def concept_columns(flags: Column, taxonomy: list[str] = CONCEPTS) -> list[Column]:
    """One 0/1 column per concept, for wide tables."""
    return [F.coalesce(flags[i], F.lit(0)).alias(c) for i, c in enumerate(taxonomy)]


def common_concepts(left: Column, right: Column) -> Column:
    """Sorted intersection without empty names."""
    both = F.array_intersect(left, right)
    return F.array_sort(F.filter(both, lambda c: c != ""))


def tag_by_words(tokens: Column, dictionary: dict[str, str]) -> Column:
    """Concepts whose words occur in ``tokens`` (dictionary: word to concept).

    Stays inside the row: the dictionary is a bounded constant, so there is nothing
    to join and nothing to shuffle.
    """
    if not dictionary:
        return F.array().cast("array<string>")
    hits = F.filter(F.array_distinct(tokens), lambda w: w.isin(*dictionary))
    return F.array_sort(F.array_distinct(F.transform(hits, lambda w: lookup(dictionary, w))))


def jaccard(left: Column, right: Column) -> Column:
    """Overlap of two sets; two empty sets give 0."""
    union = F.size(F.array_union(left, right))
    both = F.size(F.array_intersect(left, right))
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))
