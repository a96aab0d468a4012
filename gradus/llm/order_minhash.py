"""Document fingerprints: Order MinHash over words, in built-in expressions.

The k-mers of a text are its runs of ``K`` words, each numbered by its occurrence, so that
repeats count. Their hashes fall into cells; each cell keeps its smallest k-mer (one hash
for all cells). The minimal k-mers of two neighbouring cells make a tuple in the order in
which they stand in the text, and each tuple is hashed. Two texts agree in a tuple if they
share both k-mers in the same order, so the share of equal tuples falls with their edit
distance and, unlike that of plain MinHash, with moved passages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradus.functions.folding import let
from gradus.llm.staging import Stage, dense_ranks

#: Words in a k-mer, tuples in a fingerprint, hex digits of a tuple.
K, TUPLES, DIGITS = 3, 32, 8
_CELLS = 2 * TUPLES
_CELL_BITS = _CELLS.bit_length() - 1
#: A k-mer's number holds 40 bits of hash above 24 bits of position; positions count modulo
#: 2**24 words, so a longer text still has one fingerprint, with some tuples out of order.
_PLACE = (1 << 24) - 1
_NONE = "-" * DIGITS


def _at(array: Column, index: Column | int) -> Column:
    return F.get(array, F.lit(index) if isinstance(index, int) else index)


def _kmers(words: Column) -> Column:
    """Hash and position of every k-mer; fewer words than K make one."""

    def number(word: Column, i: Column) -> Column:
        whole = F.xxhash64(word, *[_at(words, i + j) for j in range(1, K)])
        return whole.bitwiseAND(~_PLACE).bitwiseOR(i.cast("long").bitwiseAND(_PLACE))

    count = F.greatest(F.size(words) - (K - 1), F.least(F.size(words), F.lit(1)))
    return F.slice(F.transform(words, number), 1, count)


def _minimal(ordered: Column) -> Column:
    """Per cell the smallest k-mer, as (cell, hash, position) in one number each.

    ``ordered`` are the sorted k-mers: equal ones stand together in text order, so a
    k-mer's occurrence is its distance from the start of its run.
    """

    def starts_run(x: Column, i: Column, shift: int) -> Column:
        return (i == 0) | (F.shiftright(x, shift) != F.shiftright(_at(ordered, i - 1), shift))

    places = F.sequence(F.lit(0), F.size(ordered) - 1)
    starts = F.filter(places, lambda i: starts_run(_at(ordered, i), i, 24))

    def occurrences(starts: Column) -> Column:
        def run(start: Column, j: Column) -> Column:
            end = F.coalesce(_at(starts, j + 1), F.size(ordered))
            return F.sequence(F.lit(0), end - start - 1)

        return F.flatten(F.transform(starts, run))

    def numbered(occurrence: Column) -> Column:
        def number(x: Column, i: Column) -> Column:
            hashed = F.xxhash64(F.shiftright(x, 24), _at(occurrence, i))
            return hashed.bitwiseAND(~_PLACE).bitwiseOR(x.bitwiseAND(_PLACE))

        return F.sort_array(F.transform(ordered, number))

    def first_of_cell(sorted_numbers: Column) -> Column:
        shift = 64 - _CELL_BITS
        return F.filter(
            sorted_numbers,
            lambda x, i: (i == 0)
            | (F.shiftright(x, shift) != F.shiftright(_at(sorted_numbers, i - 1), shift)),
        )

    return let(let(let(starts, occurrences), numbered), first_of_cell)


def _tuples(minimal: Column) -> Column:
    """The tuples' hashes in hex, those without a k-mer as dashes."""
    shift = 64 - _CELL_BITS
    cells = F.map_from_arrays(F.transform(minimal, lambda x: F.shiftright(x, shift)), minimal)

    def joined(by_cell: Column) -> Column:
        def one(t: Column) -> Column:
            a = F.element_at(by_cell, t * 2)
            b = F.element_at(by_cell, t * 2 + 1)
            ordered = F.when(
                a.bitwiseAND(_PLACE) <= b.bitwiseAND(_PLACE),
                F.xxhash64(F.shiftright(a, 24), F.shiftright(b, 24)),
            ).otherwise(F.xxhash64(F.shiftright(F.coalesce(b, a), 24), F.shiftright(a, 24), b.isNull()))
            text = F.substring(F.lpad(F.lower(F.hex(ordered)), 16, "0"), 17 - DIGITS, DIGITS)
            return F.when(a.isNull() & b.isNull(), F.lit(_NONE)).otherwise(text)

        # Cells count from -CELLS/2: the sign is the highest bit of the hash.
        numbers = F.sequence(F.lit(-TUPLES // 2).cast("long"), F.lit(TUPLES // 2 - 1).cast("long"))
        return F.array_join(F.transform(numbers, one), "")

    return let(cells, joined)


def fingerprint(text: Column) -> Column:
    """TUPLES * DIGITS characters; equal texts have equal ones.

    Words are what ASCII white space separates. NULL, empty and blank texts have dashes
    only; a text of fewer than K words has one k-mer.
    """
    split = F.split(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t-\r]+", " ")), " ")
    words = F.filter(split, lambda w: w != "")
    some = let(let(words, lambda w: F.sort_array(_kmers(w))), lambda k: let(_minimal(k), _tuples))
    blank = ~F.coalesce(text, F.lit("")).rlike(r"[^ \t-\r]")
    return F.when(blank, F.lit(_NONE * TUPLES)).otherwise(some)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples among those that either text has; 1 if neither has any."""
    places = F.sequence(F.lit(0), F.lit(TUPLES - 1))

    def counted(keep) -> Column:
        return F.size(F.filter(places, keep))

    def part(value: Column, i: Column) -> Column:
        return F.substring(value, i * DIGITS + 1, F.lit(DIGITS))

    same = counted(lambda i: (part(a, i) == part(b, i)) & (part(a, i) != _NONE))
    either = counted(lambda i: (part(a, i) != _NONE) | (part(b, i) != _NONE))
    some = F.when(either == 0, F.lit(1.0)).otherwise(same / either)
    return F.when(a.isNull() | b.isNull(), F.lit(None)).otherwise(some)


def following(df: DataFrame, stage: Stage, id_column: str, **facts: Column) -> DataFrame:
    """(id, next_id, facts) for every id: the next larger one, the first after the last.

    ``facts`` are aggregates over the rows of an id. Only ids are sorted, by ranges.
    """
    ids = df.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id"))
    ids = ids.agg(*[v.alias(k) for k, v in facts.items()] or [F.count(F.lit(1)).alias("n")])
    ranked = stage.write(dense_ranks(ids, stage, ["id"]))
    n = ranked.count()
    later = ranked.select(
        F.col("id").alias("next_id"), F.pmod(F.col("rank") - 1, F.lit(max(n, 1))).alias("rank")
    )
    return stage.write(ranked.join(later, "rank").drop("rank"))


def edited_pairs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints of each text, of its edited form, and their likeness to it.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as
    many (or all) of the next document's, in ascending order of ids, the first after the
    last. Columns: id, ``n_chars``, ``edited_sha256``, ``fingerprint``,
    ``edited_fingerprint``, ``near_edited``, ``near_next``.

    NULL texts count as empty. A row without an id has no next document: nothing is put in
    and ``near_next`` is NULL. Rows sharing an id share the next one; where the next id has
    several rows, the largest text stands for it. A single document follows itself. Further
    columns are not read, whatever their names; an empty table gives an empty one.

    What is shuffled of texts: each text once, and of the next document the part put in.
    """
    stage = Stage(df.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    docs = df.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    chain = following(
        docs, stage, "id", put_in=F.max(F.floor(F.char_length("text") / 4)).cast("int")
    )
    before = chain.select(
        F.col("id").alias("prior_id"), F.col("next_id").alias("id"), F.col("put_in").alias("wanted")
    )
    # Heads of the documents, each to the one before it.
    heads = docs.where("id IS NOT NULL").join(before, "id").select(
        F.col("prior_id").alias("id"), F.substring("text", F.lit(1), F.col("wanted")).alias("head"), "text"
    )
    heads = heads.select("id", "head", F.xxhash64("text").alias("whole"))
    heads = heads.groupBy("id").agg(F.max_by("head", F.struct("head", "whole")).alias("head"))
    # Every id has a head. Both joins read the texts by id, so they share one shuffle.
    known = docs.where("id IS NOT NULL").join(heads, "id")
    unknown = docs.where("id IS NULL").withColumn("head", F.lit(""))
    own = known.unionByName(unknown).withColumn("n_chars", F.char_length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), (F.col("n_chars") - cut).cast("int")),
        F.coalesce(F.substring("head", F.lit(1), cut), F.lit("")),
    )
    # One-element arrays, exploded: each long expression is evaluated once.
    both = own.select("id", "n_chars", "text", F.explode(F.array(edited)).alias("edited"))
    prints = F.array(F.struct(fingerprint(F.col("text")).alias("own"), fingerprint(F.col("edited")).alias("new")))
    printed = both.select(
        "id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        F.explode(prints).alias("p"),
    )
    made = stage.write(
        printed.select(
            "id", "n_chars", "edited_sha256",
            F.col("p.own").alias("fingerprint"), F.col("p.new").alias("edited_fingerprint"),
        )
    )
    nexts = made.groupBy("id").agg(F.max("fingerprint").alias("next_print"))
    nexts = nexts.join(before.select("prior_id", "id"), "id").select(
        F.col("prior_id").alias("id"), "next_print"
    )
    out = made.join(nexts, "id", "left")
    return out.select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_print")).alias("near_next"),
    )
