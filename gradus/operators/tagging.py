"""Requests to, and replies from, a tagger; the built-in taggers; caching.

The built-in concept tagger looks words up in a concept dictionary; the built-in
labeller takes the label of the nearest example. Both can be replaced by a function
over Arrow batches (``tag_with``), to which the requests built here can be sent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.functions.folding import let
from gradus.functions.text import ngrams, strip
from gradus.operators.packing import assign_packs
from gradus.operators.similarity import neighbours_of_rows
from gradus.operators.vectors import TfidfModel
from gradus.session import durable


#: Rows of the dictionary that every task holds, the most frequent words.
FREQUENT = 65_536
#: Bytes of a batch whose words are looked up at once.
BATCH_BYTES = 4 << 20


def request(
    text: Column, allowed: Sequence[str], field: str, examples: Sequence[tuple[str, str]] = ()
) -> Column:
    """One request: the allowed values, the reply format, the whole statement."""
    shots = "".join(f'- "{t}" -> {label}\n' for t, label in examples)
    head = (
        (f"Examples:\n{shots}\n" if shots else "")
        + f"Allowed values: {', '.join(allowed)}.\n"
        + f'Reply in JSON with the field "{field}".\n\n'
    )
    return F.concat(F.lit(head), text)


def pack_requests(
    df: DataFrame,
    pack_size: int = 10,
    key: str = "id",
    text: str = "text",
) -> DataFrame:
    """(pack, n, first_id, last_id, body): consecutive items, numbered from 1 per pack.

    Positions come from ranges of the ids alone, wherever these lie, and the texts join
    them afterwards; a pack gathers ``pack_size`` rows. ``packing.pack_by_size`` also bounds a
    pack's characters.
    """
    rows = durable(
        df.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), F.col(text).alias("_text"))
    )
    placed = assign_packs(rows.withColumn("_size", F.lit(0)), 0, pack_size, "_key", "_size").join(rows, "_row")
    items = F.sort_array(F.collect_list(F.struct("position", "_key", "_text")))
    body = F.array_join(
        F.transform(
            items,
            lambda x: F.concat(
                F.lit("Item "), x["position"].cast("string"), F.lit(":\n"), x["_text"]
            ),
        ),
        "\n\n",
    )
    return placed.groupBy("pack").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("_key").alias("first_id"),
        F.max("_key").alias("last_id"),
        body.alias("body"),
    )


def strip_fences(raw: Column) -> Column:
    """The reply without white space and code fences around it."""

    def inner(t: Column) -> Column:
        bare = F.regexp_replace(t, "^`+|`+$", "")
        return strip(F.regexp_replace(bare, "^(?i:json)", ""))

    return let(strip(raw), lambda t: F.when(t.startswith("```"), inner(t)).otherwise(t))


def parse_reply(raw: Column, schema: str) -> Column:
    """The reply as ``schema``: whole, else its outermost ``{}``, else ``[]``, else NULL."""

    def parse(text: Column) -> Column:
        def attempt(candidate: Column) -> Column:
            # from_json is lenient: it reads the first value and ignores what follows.
            # As the only element of an array, a candidate must be one whole value.
            wrapped = F.try_parse_json(F.concat(F.lit("["), candidate, F.lit("]")))
            first = F.try_variant_get(wrapped, "$[0]", "variant")
            second = F.try_variant_get(wrapped, "$[1]", "variant")
            return F.when(first.isNotNull() & second.isNull(), F.from_json(candidate, schema))

        whole = attempt(text)
        braces = attempt(F.nullif(F.regexp_extract(text, r"(?s)\{.*\}", 0), F.lit("")))
        brackets = attempt(F.nullif(F.regexp_extract(text, r"(?s)\[.*\]", 0), F.lit("")))
        return F.coalesce(whole, braces, brackets)

    return let(strip_fences(raw), parse)


def match_replies(
    requests: DataFrame, replies: DataFrame, value: str, retry_blank: bool = True
) -> DataFrame:
    """Requests with their reply's ``value`` and a ``retry`` flag.

    ``requests``: (pack, position, ...); ``replies``: (pack, position, value). The last
    of several replies to one position counts. ``retry_blank``: a blank value is asked
    again as well, not only an absent one.
    """
    last = replies.groupBy("pack", "position").agg(F.max_by(value, "reply_no").alias(value))
    missing = F.col(value).isNull()
    if retry_blank:
        missing = missing | (F.col(value) == "")
    return requests.join(last, ["pack", "position"], "left").withColumn("retry", missing)


Key = str | Sequence[str] | None


def key_columns(items: DataFrame, cache: DataFrame, key: Key = None) -> list[str]:
    """The columns that identify an item.

    By default (source, id), since ids repeat between sources; a cache (or items) without
    a source is that of one source and goes by id.
    """
    if key is None:
        return [c for c in ("source", "id") if c in items.columns and c in cache.columns]
    return [key] if isinstance(key, str) else list(key)


def _as_text(keys: list[str]) -> list[Column]:
    return [F.col(k).cast("string").alias(f"_{k}") for k in keys]


def _same(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).cast("string").eqNullSafe(F.col(f"_{k}")) for k in keys])


def pending(items: DataFrame, cache: DataFrame, key: Key = None) -> DataFrame:
    """Items whose key (as text) is not in the cache."""
    keys = key_columns(items, cache, key)
    return items.join(cache.select(*_as_text(keys)), _same(keys), "left_anti")


def latest(cache: DataFrame, value: str, order: str, keys: list[str]) -> DataFrame:
    """The last cached ``value`` of each key, the keys as text under ``_<name>``.

    Of several values with the same ``order`` the greatest counts, so a key that a batch
    holds twice has one defined value.
    """
    last = F.max(F.struct(F.col(order).alias("order"), F.col(value).alias("value")))
    found = cache.groupBy(*_as_text(keys)).agg(last.alias("_last"))
    return found.select(*[f"_{k}" for k in keys], F.col("_last.value").alias(value))


def align(items: DataFrame, cache: DataFrame, value: str, order: str, key: Key = None) -> DataFrame:
    """Items with their last cached ``value``; NULL where there is none."""
    keys = key_columns(items, cache, key)
    found = latest(cache, value, order, keys)
    return items.join(found, _same(keys), "left").drop(*[f"_{k}" for k in keys])


def _frequent(dictionary: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` rows of (word, concept), all rows of each of their words.

    With a column ``df`` (the same for all rows of a word) the most frequent words; without
    one the whole dictionary, or nothing when it is larger.
    """
    known = dictionary.where(F.col("word").isNotNull() & F.col("concept").isNotNull())
    if "df" not in dictionary.columns:
        rows = known.select("word", "concept")
        return rows if len(rows.limit(limit + 1).collect()) <= limit else rows.where(F.lit(False))
    # Few different frequencies, however many words.
    sizes = known.groupBy("df").agg(F.count(F.lit(1)).alias("n")).where("df IS NOT NULL")
    held = F.sum("n").over(Window.orderBy(F.desc("df")))
    cut = sizes.withColumn("_held", held).where(F.col("_held") <= limit).agg(F.min("df")).first()[0]
    return known.where(F.lit(False) if cut is None else F.col("df") >= cut).select("word", "concept")


def _look_up(df: DataFrame, frequent: Sequence[tuple[str, str]], n_concepts: int) -> DataFrame:
    """``df`` with ``_words`` replaced by ``concepts`` of frequent words and ``rest``, the other words.

    A row that has all ``n_concepts`` already has no rest: no further word can add to it.
    """
    names = sorted({concept for _, concept in frequent})
    number = {name: i for i, name in enumerate(names)}
    of_word: dict[str, set[int]] = {}
    for word, concept in frequent:
        of_word.setdefault(word, set()).add(number[concept])
    starts = np.cumsum([0, *map(len, of_word.values())])
    codes = np.array([code for found in of_word.values() for code in sorted(found)], "int64")
    shared = df.sparkSession.sparkContext.broadcast((list(of_word), names, starts, codes))
    fields = [f for f in df.schema.fields if f.name != "_words"]
    out = T.StructType([*fields, *T._parse_datatype_string("concepts array<string>, rest array<string>").fields])
    columns = out.fieldNames()

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        words, names, starts, codes = shared.value
        lists = batch.column("_words")
        flat, n = lists.flatten(), batch.num_rows
        row = np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        at = pc.fill_null(pc.index_in(flat, value_set=pa.array(words, flat.type)), -1).to_numpy(zero_copy_only=False)
        hit = at >= 0
        first, many = starts[at[hit]], starts[at[hit] + 1] - starts[at[hit]]
        inside = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        pairs = np.unique(np.repeat(row[hit], many) * len(names) + codes[np.repeat(first, many) + inside])
        held, code = np.divmod(pairs, max(1, len(names)))
        count = np.bincount(held, minlength=n)
        left = ~hit & (count < n_concepts)[row] & pc.is_valid(flat).to_numpy(zero_copy_only=False)

        def lists_of(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
            return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *sizes]), "int32"), values)

        found = lists_of(pa.array(names, flat.type).take(pa.array(code)), count)
        rest = lists_of(flat.filter(pa.array(left)), np.bincount(row[left], minlength=n))
        own = [batch.column(c) for c in columns[:-2]]
        return pa.RecordBatch.from_arrays([*own, found, rest], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            rows = max(1, whole.num_rows * BATCH_BYTES // max(whole.nbytes, 1))
            for start in range(0, whole.num_rows, rows):
                yield look(whole.slice(start, rows))

    return df.mapInArrow(run, out)


def tag_by_dictionary(
    df: DataFrame, dictionary: DataFrame, keys: Sequence[str], tokens: str = "words", longest: int = 1,
    limit: int = FREQUENT,
) -> DataFrame:
    """``df`` plus ``concepts``: the sorted names of the terms that occur in ``tokens``.

    ``dictionary`` is a table (word, concept) of any size, perhaps with ``df``, a word's
    frequency; with ``longest`` above 1 its words may be phrases of up to so many tokens.
    At most ``limit`` of its rows, the most frequent ones, are looked up where the tokens
    stand. Only rows that still lack a concept send their other tokens to a join with the
    whole dictionary. Rows without a hit get an empty set; rows that share their keys share
    their concepts.
    """
    keys = list(keys)
    phrases = F.col(tokens) if longest == 1 else ngrams(F.col(tokens), longest)
    named = [F.col(k).alias(f"_{k}") for k in keys]
    hidden = [f"_{k}" for k in keys]
    frequent = [(r.word, r.concept) for r in _frequent(dictionary, limit).collect()]
    n_concepts = dictionary.agg(F.count_distinct("concept")).first()[0]
    seen = durable(_look_up(df.select(*named, F.array_distinct(phrases).alias("_words")), frequent, n_concepts))
    # Stored, so that its true size decides how it is joined. The dictionary is joined as it
    # lies: copies of its rows would not count for its size, and fill the driver when broadcast.
    rest = durable(seen.select(*hidden, F.explode("rest").alias("word")))
    joined = rest.join(dictionary.select("word", "concept"), "word").groupBy(*hidden).agg(F.collect_set("concept").alias("concepts"))
    both = seen.select(*hidden, "concepts").unionByName(joined)
    found = both.groupBy(*hidden).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("concepts")))).alias("concepts")
    )
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    tagged = df.join(found, same, "left").drop(*hidden)
    return tagged.withColumn("concepts", F.coalesce("concepts", F.array().cast("array<string>")))


def label_by_example(
    rows: DataFrame, examples: DataFrame, model: TfidfModel, keep: tuple[str, ...] = ("id",)
) -> DataFrame:
    """(keep..., pred, cosine): the label of the nearest example (first one on a tie).

    ``rows``: prepared vectors; ``examples``: query, label and prepared vectors.
    """
    near = neighbours_of_rows(rows, examples.drop("label"), model.size, 1, keep)
    labels = examples.select(F.col("query").alias("reference"), F.col("label").alias("pred"))
    return near.join(F.broadcast(labels), "reference").select(*keep, "pred", "cosine")


def tag_with(
    df: DataFrame,
    function: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """Hook for a user's own model: a function over Arrow batches."""

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield function(part)

    return df.mapInPandas(batches, schema)


def classify_with_cache(
    items: DataFrame,
    path: str,
    classify: Callable[[DataFrame], DataFrame],
    schema: str,
    key: Key = None,
    value: str = "pred",
) -> DataFrame:
    """Classify what the cache lacks, append it, return every item with its value.

    ``classify`` maps rows of items to their key columns and ``value``. Each call appends
    one batch, which the commit protocol publishes whole; running again continues where
    it stopped. The key is that of ``key_columns``: with a source in ``schema`` and in the
    items, one source's value is never given to another's item.
    """
    from gradus.sources.tables import publish, read_cache

    spark = items.sparkSession
    cache = read_cache(spark, path, schema)
    keys = key_columns(items, cache, key)
    todo = pending(items, cache, keys)
    if not todo.isEmpty():
        made = classify(todo)
        if absent := [k for k in keys if k not in made.columns]:
            raise ValueError(f"classified rows lack key columns: {absent}")
        publish(made.withColumn("written", F.current_timestamp()), path)
    return align(items, read_cache(spark, path, schema), value, "written", keys)
