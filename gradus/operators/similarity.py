"""Scoring a catalog against many queries, and the best k per query.

Every query is compared with every catalog row, as the semantics ask. What keeps that
affordable on a cluster:

* Queries become a dense block of bounded size (``BLOCK_VALUES`` numbers), broadcast to
  the tasks. More queries than fit make several blocks, each a pass over the catalog;
  no side is ever broadcast because it is believed to be small. Queries of one level
  share their blocks, which then read the levels of one window.
* A task multiplies its catalog rows with the block (Arrow batches, one matrix product)
  and keeps k rows per query. Pairs are never written, joined or shuffled; only
  tasks x queries x k rows are, and several blocks share the cores, so a block has few
  tasks. Frequent terms, repeated texts and large sources cost nothing extra, because work
  is divided by rows, not by key.
* Once a task has k rows for a query, scores in single precision say which rows can still be
  among them; only those are scored in double precision. They are one matrix product over
  frequent terms, and products over the pairs that share a rare one.
* Scores are rounded before ranking and ties go to (source, id), so results do not
  depend on the order of summation or on the partitioning.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradus.operators.vectors import sparse_entries
from gradus.schema import CONCEPT_WEIGHT, CONCEPTS, DUPLICATE_COSINE
from gradus.session import durable, release

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_VALUES = 8_000_000  # 64 MB of doubles
CATALOG_VALUES = 4_000_000  # dense rows a task holds at a time: 32 MB
WAVE = 16  # blocks in flight
TASKS = 3  # for each core, over the blocks in flight
#: Levels whose queries have blocks of their own; with more of them blocks are dealt whatever the level.
LEVEL_GROUPS = 8
DIGITS = 6
#: What single precision may add to or take from a score.
_SLACK = 1e-4
#: Scores a task screens at a time: 16 MB.
SCREEN_VALUES = 4_000_000
#: Costs of a term in the screen: of a pair in the matrix product, of a pair that has it, and of the term.
PRODUCT_COST, PAIR_COST, TERM_COST = 0.02, 10.0, 6_000.0
#: Share of the pairs that may pass the screen; beyond it the whole batch is scored exactly.
SCREENED = 1 / 16
#: Rows of exclusions of one block that are broadcast; more are joined.
EXCLUDED_ROWS = 100_000

Task = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

SCORE_SCHEMA = (
    "query long, source string, id long, cosine double, jaccard double, "
    "score double, in_window boolean"
)


@dataclass(frozen=True)
class Rules:
    """What counts as a candidate, and how it is scored."""

    k: int = 5
    window: int | None = None  # level distance allowed; None: any level
    relax: bool = False  # no candidate in the window: take any level
    max_cosine: float | None = None  # strictly below; None keeps near-duplicates
    exclude_self: bool = False  # the row with the query's own (source, id)
    concept_weight: float = 0.0  # weight of concept overlap in the score
    digits: int = DIGITS


@dataclass(frozen=True)
class Block:
    """A bounded set of queries as arrays."""

    query: np.ndarray  # query numbers
    terms: np.ndarray  # vocabulary entries any query uses
    weights: np.ndarray  # terms x queries
    concepts: np.ndarray  # queries x taxonomy, 0/1
    level: np.ndarray  # NaN: unknown
    own: np.ndarray  # "source\0id", or ""


def _own_key(source: pd.Series, ids: pd.Series) -> np.ndarray:
    return (source.astype(str) + "\0" + ids.astype("int64").astype(str)).to_numpy(object)


def _dense(idx: list, w: list, size: int) -> np.ndarray:
    """Rows of sparse entries as a dense matrix."""
    out = np.zeros((len(idx), size))
    lengths = [len(i) for i in idx]
    if sum(lengths):
        # Rows without entries may come as empty lists, which numpy takes for floats.
        column = np.concatenate([np.asarray(i, "int64") for i in idx])
        out[np.repeat(np.arange(len(idx)), lengths), column] = np.concatenate(w)
    return out


def _flags(values: pd.Series) -> np.ndarray:
    return np.array([v if v is not None else [0] * len(CONCEPTS) for v in values], float).reshape(
        len(values), len(CONCEPTS)
    )


def _block(rows: pd.DataFrame, size: int) -> Block:
    dense = _dense(list(rows["idx"]), list(rows["w"]), size)
    terms = np.flatnonzero(dense.any(axis=0))
    return Block(
        query=rows["query"].to_numpy("int64"),
        terms=terms,
        weights=dense[:, terms].T,  # the terms of a query lie side by side
        concepts=_flags(rows["flags"]),
        level=rows["level"].to_numpy("float64"),
        own=np.where(rows["id"].isna(), "", _own_key(rows["source"], rows["id"].fillna(-1))),
    )


def _jaccard(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    both = left @ right.T
    union = left.sum(axis=1)[:, None] + right.sum(axis=1)[None, :] - both
    return np.divide(both, union, out=np.zeros_like(both), where=union > 0)


def _top(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best allowed rows per column; earlier rows win ties."""
    ranked = np.where(allowed, score, -np.inf)
    if len(ranked) > k:
        cut = -np.partition(-ranked, k - 1, axis=0)[k - 1]
    else:
        cut = np.full(ranked.shape[1], -np.inf)
    column, row = np.nonzero((allowed & (ranked >= cut)).T)
    order = np.lexsort((row, -ranked[row, column], column))
    row, column = row[order], column[order]
    place = np.arange(len(column)) - np.searchsorted(column, column)
    return row[place < k], column[place < k]


def _score_batch(pdf: pd.DataFrame, block: Block, rules: Rules, size: int) -> pd.DataFrame:
    # Sorted once, so that "earlier row" means smaller (source, id).
    pdf = pdf.sort_values(["source", "id"], ignore_index=True)
    dense = _dense(list(pdf["idx"]), list(pdf["w"]), size)
    exact = dense[:, block.terms] @ block.weights
    cosine = np.round(exact, rules.digits)
    if rules.concept_weight:
        overlap = _jaccard(_flags(pdf["flags"]), block.concepts)
        asked = block.concepts.any(axis=1)
        share = np.where(asked, rules.concept_weight, 0.0)
        score = np.round(share * overlap + (1 - share) * exact, rules.digits)
        overlap = np.round(overlap, rules.digits)
    else:
        overlap = np.zeros_like(cosine)
        score = cosine
    allowed = np.ones(score.shape, bool)
    if rules.max_cosine is not None:
        allowed &= cosine < rules.max_cosine
    if rules.exclude_self:
        allowed &= _own_key(pdf["source"], pdf["id"])[:, None] != block.own[None, :]
    if "excluded_by" in pdf:
        position = {q: i for i, q in enumerate(block.query)}
        for row, queries in enumerate(pdf["excluded_by"]):
            if queries is not None and len(queries):
                allowed[row, [position[q] for q in queries if q in position]] = False
    within = np.ones(score.shape, bool)
    if rules.window is not None:
        gap = np.abs(pdf["level"].to_numpy("float64")[:, None] - block.level[None, :])
        within = (gap <= rules.window) | np.isnan(block.level)[None, :]
    picks = [(_top(score, allowed & within, rules.k), True)]
    if rules.window is not None and rules.relax:
        picks.append((_top(score, allowed & ~within, rules.k), False))
    parts = [
        pd.DataFrame(
            {
                "query": block.query[column],
                "source": pdf["source"].to_numpy(object)[row],
                "id": pdf["id"].to_numpy("int64")[row],
                "cosine": cosine[row, column],
                "jaccard": overlap[row, column],
                "score": score[row, column],
                "in_window": flag,
            }
        )
        for (row, column), flag in picks
    ]
    return pd.concat(parts, ignore_index=True)


def _best(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = pdf.sort_values(
        ["query", "in_window", "score", "source", "id"], ascending=[True, False, False, True, True]
    )
    return ordered.groupby(["query", "in_window"], sort=False).head(k)


def _floors(best: pd.DataFrame, block: Block, k: int) -> np.ndarray:
    """The score a row must reach to be among the best of each query; -inf while there are fewer than k."""
    order = np.argsort(block.query)
    at = order[np.searchsorted(block.query, best["query"].to_numpy(), sorter=order)]
    floor = np.full(len(block.query), np.inf)
    np.minimum.at(floor, at, best["score"].to_numpy())
    return np.where(np.bincount(at, minlength=len(floor)) >= k, floor, -np.inf)


class _Rare:
    """The queries of a block that have a term, for terms that few rows have."""

    def __init__(self, block: Block) -> None:
        self.single = block.weights.astype("float32", order="C")
        term, self.query = np.nonzero(self.single)
        self.weight = self.single[term, self.query]
        self.count = np.bincount(term, minlength=len(block.terms))
        self.start = np.cumsum(self.count) - self.count


def _rough(n: int, row: np.ndarray, term: np.ndarray, w: np.ndarray, rare: _Rare) -> np.ndarray:
    """Scores of ``n`` rows in single precision, from their entries: ``term`` is a place in the block.

    A term that many rows and queries have is a column of a matrix product; the products of
    another one are added to the few pairs that have it.
    """
    n_terms, width = rare.single.shape
    count = np.bincount(term, minlength=n_terms)
    alone = PAIR_COST * count * rare.count + TERM_COST
    met = (count > 0) & (rare.count > 0)
    common = met & (alone > PRODUCT_COST * n * width)
    column = np.cumsum(common) - 1
    head, m = rare.single[common], int(common.sum())
    dense, inside = np.zeros((n, m), "float32"), common[term]
    dense[row[inside], column[term[inside]]] = w[inside]
    rough = dense @ head
    left = (met & ~common)[term]
    row, term, w = row[left], term[left], w[left].astype("float32")
    order = np.argsort(term.astype("uint16") if n_terms < 65_536 else term, kind="stable")
    row, w = row[order, None], w[order, None]
    ends = np.cumsum(np.bincount(term, minlength=n_terms))
    for t in np.flatnonzero(met & ~common):
        mine = slice(ends[t] - count[t], ends[t])
        theirs = slice(rare.start[t], rare.start[t] + rare.count[t])
        rough[row[mine], rare.query[theirs]] += w[mine] * rare.weight[theirs]
    return rough


def _screen_batch(
    pdf: pd.DataFrame, block: Block, rare: _Rare, floor: np.ndarray, rules: Rules, size: int
) -> pd.DataFrame | None:
    """The rows that may still be among the best, scored exactly; None when most pairs may be.

    Scores in single precision say which pairs reach the floor of their query, less what
    rounding may take; only those are scored in double precision and held against the rules.
    """
    n, width = len(pdf), len(block.query)
    lengths = np.array([len(i) for i in pdf["idx"]])
    start = np.cumsum(lengths) - lengths
    term = np.concatenate([np.asarray(i, "int64") for i in pdf["idx"]])
    w = np.concatenate([np.asarray(x, "float64") for x in pdf["w"]])
    place = np.full(size, len(block.terms))
    place[block.terms] = np.arange(len(block.terms))
    term = place[term]
    known = term < len(block.terms)  # the others no query has
    rough = _rough(n, np.repeat(np.arange(n), lengths)[known], term[known], w[known], rare)
    if rules.concept_weight:
        # Few concept sets are different, so overlaps are computed for sets.
        own, row_set = np.unique(_flags(pdf["flags"]), axis=0, return_inverse=True)
        asked, query_set = np.unique(block.concepts, axis=0, return_inverse=True)
        overlaps = _jaccard(own, asked)
        share = np.where(asked.any(axis=1), rules.concept_weight, 0.0)
        rough *= (1 - share)[query_set].astype("float32")
        rough += (share * overlaps).astype("float32")[row_set][:, query_set]
    row, column = np.nonzero(rough >= (floor - _SLACK).astype("float32"))
    if len(row) > SCREENED * rough.size:
        return None
    within = np.ones(len(row), bool)
    if rules.window is not None:
        gap = np.abs(pdf["level"].to_numpy("float64")[row] - block.level[column])
        within = (gap <= rules.window) | np.isnan(block.level[column])
    if rules.exclude_self:
        within &= _own_key(pdf["source"], pdf["id"])[row] != block.own[column]
    if "excluded_by" in pdf:
        position = {q: i for i, q in enumerate(block.query)}
        barred = [
            r * width + position[q]
            for r, queries in enumerate(pdf["excluded_by"])
            if queries is not None
            for q in queries
            if q in position
        ]
        within &= ~np.isin(row * width + column, barred)
    row, column = row[within], column[within]
    # By query, so that what is read of the block stays near.
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    exact = np.zeros(len(row))
    for piece in range(0, len(row), 4096):
        r, c = row[piece : piece + 4096], column[piece : piece + 4096]
        many = lengths[r]
        begins = np.cumsum(many) - many
        flat = np.repeat(start[r] - begins, many) + np.arange(many.sum())
        pair = np.repeat(np.arange(len(r)), many)
        known = term[flat] < len(block.terms)
        flat, pair = flat[known], pair[known]
        exact[piece : piece + 4096] = np.bincount(pair, w[flat] * block.weights[term[flat], c[pair]], len(r))
    cosine = np.round(exact, rules.digits)
    overlap, score = np.zeros(len(row)), cosine
    if rules.concept_weight:
        overlap, part = overlaps[row_set[row], query_set[column]], share[query_set[column]]
        score = np.round(part * overlap + (1 - part) * exact, rules.digits)
    kept = score >= floor[column]
    if rules.max_cosine is not None:
        kept &= cosine < rules.max_cosine
    row, column = row[kept], column[kept]
    return pd.DataFrame(
        {
            "query": block.query[column],
            "source": pdf["source"].to_numpy(object)[row],
            "id": pdf["id"].to_numpy("int64")[row],
            "cosine": cosine[kept],
            "jaccard": np.round(overlap[kept], rules.digits),
            "score": score[kept],
            "in_window": True,
        }
    )


def _score_task(shared: Broadcast, rules: Rules, size: int) -> Task:
    """k rows per query from the catalog rows of one task."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block(**shared.value)
        step = max(1, CATALOG_VALUES // max(size, len(block.query)))
        most = max(step, min(SCREEN_VALUES // max(1, len(block.query)), SCREEN_VALUES // size * 4))
        rare = _Rare(block)
        # With relaxed windows rows outside count only if there is none inside: no floor.
        relaxed = rules.window is not None and rules.relax
        floor: np.ndarray | None = None
        found: list[pd.DataFrame] = []
        seen = 0
        for batch in batches:
            start = 0
            while start < len(batch):
                # As many rows as the floor rests on: with a low floor most rows would pass.
                rows = batch.iloc[start : start + (step if floor is None else min(most, max(step, seen)))]
                start, seen = start + len(rows), seen + len(rows)
                some = None if floor is None else _screen_batch(rows, block, rare, floor, rules, size)
                pieces = [some]
                if some is None:
                    pieces = [_score_batch(rows.iloc[i : i + step], block, rules, size) for i in range(0, len(rows), step)]
                found += pieces
                if len(found) == len(pieces) or sum(map(len, found[1:])) >= len(block.query):
                    found = [_best(pd.concat(found), rules.k)]
                    floor = None if relaxed else _floors(found[0], block, rules.k)
        if found:
            yield _best(pd.concat(found), rules.k)

    return score


def _count_task(shared: Broadcast, threshold: float, size: int) -> Task:
    """How many catalog rows of one task reach the threshold, per query."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block(**shared.value)
        step = max(1, CATALOG_VALUES // max(size, len(block.query)))
        for batch in batches:
            for start in range(0, len(batch), step):
                pdf = batch.iloc[start : start + step]
                pdf = pdf.sort_values(["source", "id"], ignore_index=True)
                dense = _dense(list(pdf["idx"]), list(pdf["w"]), size)
                hit = np.round(dense[:, block.terms] @ block.weights, DIGITS) >= threshold
                some = np.flatnonzero(hit.any(axis=0))
                first = hit[:, some].argmax(axis=0)
                yield pd.DataFrame(
                    {
                        "query": block.query[some],
                        "n": hit[:, some].sum(axis=0),
                        "source": pdf["source"].to_numpy(object)[first],
                        "id": pdf["id"].to_numpy("int64")[first],
                    }
                )

    return count


def _deal(queries: DataFrame, width: int, block_values: int, by_level: bool) -> tuple[Column, int]:
    """(number of a query's block, number of blocks) for stored queries.

    Queries of one level share their blocks, so that a block's window is as narrow as theirs.
    """
    level = F.col("level") if by_level else F.lit(None).cast("double")
    sizes = [(r.level, r.n) for r in queries.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()]
    if len(sizes) > LEVEL_GROUPS:
        return _deal(queries, width, block_values, by_level=False)
    number, first = F.lit(0), 0
    for value, n in sorted(sizes, key=lambda x: (x[0] is None, x[0])):
        many = max(1, -(-n * width // block_values))
        own = F.lit(first) + F.pmod(F.xxhash64("query"), F.lit(many)).cast("int")
        number = F.when(level.eqNullSafe(F.lit(value).cast("double")), own).otherwise(number)
        first += many
    return number, max(1, first)


def _passes(
    queries: DataFrame,
    catalog: DataFrame,
    size: int,
    block_values: int,
    task: Callable[[Broadcast], Task],
    schema: str,
    merge: Callable[[DataFrame], DataFrame],
    exclude: DataFrame | None = None,
    window: int | None = None,
    stored: bool = False,
) -> DataFrame:
    """Every block of queries against the catalog.

    With a ``window`` a block reads only the levels that its queries accept: of a catalog
    stored by level, only those folders. A query of unknown level accepts all of them.

    With more than one block both sides are computed once, in storage all executors
    reach (``stored``: the catalog lies there already). A block is then given few tasks, as
    others run beside it: each sees much of the catalog and leaves its best rows once. With
    more than ``WAVE`` blocks each wave of them is finished, merged by ``merge`` and stored
    before the next, so the driver never holds more than a wave, and what lies on disk are
    the best rows of every query.
    """
    context = catalog.sparkSession.sparkContext
    width = size + len(CONCEPTS)
    kept = queries.persist()
    n_blocks = max(1, -(-kept.count() * width // block_values))
    queries, block_number, made = kept, F.lit(0), []
    if n_blocks > 1:
        queries = durable(kept)
        kept.unpersist()
        block_number, n_blocks = _deal(queries, width, block_values, window is not None)
        made.append(queries)
        if not stored:
            catalog = durable(catalog)
        if exclude is not None:
            # Computed once and not for every block; how many rows each has is counted here.
            numbers = queries.select("query", block_number.alias("block")).distinct()
            exclude = durable(exclude.join(numbers, "query"))
            made.append(exclude)
            counts = exclude.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
            barred = {r.block: r.n for r in counts.collect()}
    several = n_blocks > 1
    parts = max(1, -(-TASKS * context.defaultParallelism // min(WAVE, n_blocks)))

    def in_window(df: DataFrame, rows: pd.DataFrame) -> DataFrame:
        asked = rows["level"].unique()
        if window is None or not len(asked) or pd.isna(asked).any():
            return df
        return df.where(F.col("level").between(float(asked.min()) - window, float(asked.max()) + window))

    finished: list[DataFrame] = []
    open_passes: list[DataFrame] = []
    shares: list[Broadcast] = []
    for number in range(n_blocks):
        rows = (queries.where(block_number == number) if several else queries).toPandas()
        target = in_window(catalog, rows)
        if exclude is not None:
            own = exclude.where(F.col("block") == number).drop("block") if several else exclude
            target = _excluded(target, own, several and barred.get(number, 0) <= EXCLUDED_ROWS)
        shares.append(context.broadcast(vars(_block(rows, size))))
        open_passes.append((target.coalesce(parts) if several else target).mapInPandas(task(shares[-1]), schema))
        if len(open_passes) == WAVE and (stored or number + 1 < n_blocks) or stored and number + 1 == n_blocks:
            # A query is in one block, so the wave has all that is found for it.
            finished.append(durable(merge(reduce(DataFrame.unionByName, open_passes)).select(*open_passes[0].columns)))
            for share in shares:
                share.destroy()
            open_passes, shares = [], []
    if not several:
        kept.unpersist()
    if stored:  # everything is finished
        for table in made:
            release(table)
    return merge(reduce(DataFrame.unionByName, finished + open_passes))


def prepare(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(source, id, level, flags, idx, w) from a table with ``features``.

    ``level`` (ordinal) and ``flags`` (0/1 concept array) may be absent.
    """
    columns = {
        "source": F.col("source") if "source" in df.columns else F.lit(""),
        "id": F.col("id").cast("long"),
        "level": (F.col("level") if "level" in df.columns else F.lit(None)).cast("double"),
        "flags": (F.col("flags") if "flags" in df.columns else F.lit(None)).cast("array<int>"),
    }
    shaped = df.select(
        "features", *[c.alias(name) for name, c in columns.items()], *extra
    )
    return sparse_entries(shaped, *columns, *extra)


def _excluded(catalog: DataFrame, exclude: DataFrame, small: bool = False) -> DataFrame:
    """Attach the queries a catalog row is barred from (at most one block of them).

    With ``small``, a checked number of rows, the catalog stays where it is.
    """
    per_row = exclude.groupBy("source", "id").agg(F.collect_set("query").alias("excluded_by"))
    return catalog.join(F.broadcast(per_row) if small else per_row, ["source", "id"], "left")


def rank_candidates(
    queries: DataFrame,
    catalog: DataFrame,
    size: int,
    rules: Rules,
    exclude: DataFrame | None = None,
    block_values: int = BLOCK_VALUES,
    stored: bool = False,
) -> DataFrame:
    """(query, rank, source, id, score, cosine, jaccard), the best k per query.

    ``queries``: query (long), source, id, level, flags, idx, w. ``catalog``: the
    output of ``prepare``. ``exclude``: (query, source, id) pairs to leave out.
    ``size`` is the length of the vocabulary. With ``stored`` the catalog is a stored table,
    and the result is computed here and stored as well.
    """
    return _passes(
        queries,
        catalog,
        size,
        block_values,
        lambda shared: _score_task(shared, rules, size),
        SCORE_SCHEMA,
        lambda found: _merge(found, rules),
        exclude,
        None if rules.relax else rules.window,
        stored,
    )


def _merge(found: DataFrame, rules: Rules) -> DataFrame:
    """The k best over all tasks. At most tasks x k rows meet per query, and the rank
    limit is applied in each task before the shuffle."""
    score = F.desc("score")
    if rules.window is not None and rules.relax:
        # Rows inside the window come first; they hide the others when there are any.
        order = Window.partitionBy("query").orderBy(F.desc("in_window"), score, "source", "id")
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= rules.k)
        top_in = F.max("in_window").over(Window.partitionBy("query"))
        kept = best.withColumn("_any", top_in).where(F.col("in_window") == F.col("_any"))
    else:
        order = Window.partitionBy("query").orderBy(score, "source", "id")
        kept = found.withColumn("rank", F.row_number().over(order)).where(
            F.col("rank") <= rules.k
        )
    return kept.select(
        "query", "rank", "source", "id", "score", "cosine", "jaccard", "in_window"
    )


def as_queries(prepared: DataFrame, number: str = "query") -> DataFrame:
    """Query rows from the output of ``prepare`` with a ``query`` number column."""
    return prepared.select(
        F.col(number).cast("long").alias("query"), "source", "id", "level", "flags", "idx", "w"
    )


def similar_topk(queries: DataFrame, catalog: DataFrame, size: int, k: int = 5) -> DataFrame:
    """The k rows nearest by cosine, for every query."""
    return rank_candidates(queries, catalog, size, Rules(k=k))


def near_duplicates(
    queries: DataFrame,
    catalog: DataFrame,
    size: int,
    threshold: float = DUPLICATE_COSINE,
    block_values: int = BLOCK_VALUES,
) -> DataFrame:
    """(query, n, source, id): how many catalog rows reach the threshold, and the first.

    A text may be copied to a third of the catalog, so copies are counted in the tasks
    and never listed.
    """
    def merge(parts: DataFrame) -> DataFrame:
        return parts.groupBy("query").agg(
            F.sum("n").alias("n"),
            F.min(F.struct("source", "id")).alias("first"),
        ).select("query", "n", "first.source", "first.id")

    return _passes(
        queries,
        catalog,
        size,
        block_values,
        lambda shared: _count_task(shared, threshold, size),
        "query long, n long, source string, id long",
        merge,
    )


def blended_rules(k: int = 5, **options) -> Rules:
    """Rules with the usual blend of concept overlap and cosine."""
    return Rules(k=k, concept_weight=CONCEPT_WEIGHT, **options)


def neighbours_of_rows(
    rows: DataFrame, reference: DataFrame, size: int, k: int, keep: tuple[str, ...] = ("source", "id")
) -> DataFrame:
    """The k rows of a small reference set nearest to every streamed row.

    The other orientation: here the reference set is the broadcast block, so each row
    is finished where it stands and nothing is shuffled. For reference sets of a fixed
    size (few-shot examples); a larger one is refused rather than broadcast.
    """
    limit = max(1, BLOCK_VALUES // (size + len(CONCEPTS)))
    examples = reference.limit(limit + 1).toPandas()
    if len(examples) > limit:
        raise ValueError(f"reference set exceeds {limit} rows; use rank_candidates")
    examples = examples.sort_values("query", ignore_index=True)
    shared = rows.sparkSession.sparkContext.broadcast(vars(_block(examples, size)))
    step = max(1, CATALOG_VALUES // size)

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block(**shared.value)
        for batch in batches:
            for start in range(0, len(batch), step):
                pdf = batch.iloc[start : start + step].reset_index(drop=True)
                dense = _dense(list(pdf["idx"]), list(pdf["w"]), size)
                cosine = np.round(dense[:, block.terms] @ block.weights, DIGITS)
                example, row = _top(cosine.T, np.ones(cosine.T.shape, bool), k)
                found = pdf.loc[row, list(keep)].reset_index(drop=True)
                found["reference"] = block.query[example]
                found["cosine"] = cosine[row, example]
                yield found

    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = ", ".join(f"{c} {types[c]}" for c in keep) + ", reference long, cosine double"
    return rows.mapInPandas(nearest, schema)
