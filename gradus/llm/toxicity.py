"""Toxicity: a classifier chain over categories, each a linear model.

The categories are predicted one after the other, and each model sees the probabilities of
the categories before it. It is trained on out-of-fold probabilities: those that models
without the row's own fold gave it, so that a later model meets in training what it meets
in use. The last category is the annotators' label.

A document's features are all its words and their beginnings, hashed into a space of fixed
size, so no word is left out by its rank and inflected forms share what they begin with.
Word statistics come from all labelled documents in one job; each different word set counts
once with a label, however many copies it has. The models are fitted on a sample of those
sets of bounded size (``rows``).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gradus.llm.arrow import extend, texts
from gradus.llm.staging import Stage

#: Categories in the order of the chain: has features that go with the label; has many of
#: them; is toxic by the label.
CATEGORIES = ("abusive", "severe", "toxic")
#: Labelled word sets that the models are fitted on, folds.
ROWS, FOLDS = 20_000, 5
#: Places of the feature space, and lengths of the word beginnings that are features.
SPACE, BEGINNINGS = 1 << 18, (3, 4, 5)
#: A feature is flagged if its smoothed odds ratio between toxic documents and others is at
#: least ODDS, and above 1 by ERRORS standard errors. Neither depends on the number of rows.
ODDS, ERRORS = 4.0, 3.0
#: A weight's prior deviation is what is left of the feature's log odds ratio, either way,
#: after so many standard errors; a feature with nothing left has the weight 0.
DOUBT = 2.0
#: Flagged features from which a toxic document is severe.
MANY = 3
#: Features of all rows that a pass of the solver holds as numbers at once.
_PIECE = 1 << 20

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def _word_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's different words, packed: about a quarter of its text's size."""
    for batch in batches:
        packed = [zlib.compress(" ".join(sorted(set(words_of(t)))).encode(), 1) for t in texts(batch, "text")]
        yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(packed, pa.binary())], names=["_id", "words"])


@lru_cache(1 << 16)
def _places(word: str) -> bytes:
    """Places of a word and its beginnings, which differ from whole words by a final sign:
    packed, so that what a worker remembers stays small."""
    forms = [word, *(word[:n] + "-" for n in BEGINNINGS if len(word) > n)]
    return b"".join([(zlib.crc32(form.encode()) % SPACE).to_bytes(4, "little") for form in forms])


def places_of(words: Iterable[str]) -> np.ndarray:
    """Places of a document's words, each once, in order."""
    return np.unique(np.frombuffer(b"".join(map(_places, words)), np.int32))


def _unpacked(packed: bytes) -> list[str]:
    return zlib.decompress(packed).decode().split()


def _place_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with each place, toxic and others, summed per task; all rows at place SPACE."""
    counts = np.zeros((2, SPACE + 1), np.int64)
    for batch in batches:
        for packed, label in zip(batch.column("words"), batch.column("label").to_pylist(), strict=True):
            own = counts[1 if label else 0]
            own[places_of(_unpacked(packed.as_py()))] += 1
            own[SPACE] += 1
    _places.cache_clear()  # workers go on to other tasks
    at = np.flatnonzero(counts.any(0))
    for start in range(0, len(at), 1 << 14):
        part = at[start : start + (1 << 14)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(counts[1, part]), pa.array(counts[0, part])],
            names=["place", "toxic", "other"],
        )


def labelled_sets(docs: DataFrame, known: DataFrame) -> DataFrame:
    """Each different word set of ``docs`` (_id, text) with each label it has in ``known``
    (_id, label), once: words, label.

    Labels grow with the documents, so the join is the same at every size and broadcasts
    nothing. What it shuffles of a document are its packed words, not its text.
    """
    schema = T.StructType([docs.schema["_id"], T.StructField("words", T.BinaryType())])
    labelled = docs.mapInArrow(_word_sets, schema).join(known.hint("merge"), "_id")
    return labelled.select("words", F.col("label").cast("boolean").alias("label")).distinct()


def log_odds(toxic: np.ndarray, other: np.ndarray, t: int, o: int) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed log odds ratios and their standard errors, from the rows with each place
    among ``t`` toxic rows and ``o`` others."""
    a, b, c, d = toxic + 0.5, other + 0.5, t - toxic + 0.5, o - other + 0.5
    return np.log(a * d / (b * c)), np.sqrt(1 / a + 1 / b + 1 / c + 1 / d)


class Rows:
    """Documents as their places, in pieces of about _PIECE places."""

    def __init__(self, places: list[np.ndarray], space: int = SPACE):
        self.n, self.space = len(places), space
        self.pieces: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        start, size = 0, 0
        for i, own in enumerate([*places, None]):
            if own is None or size and size + len(own) > _PIECE:
                part = places[start:i]
                if part:
                    at = np.repeat(np.arange(len(part), dtype=np.int32), [len(x) for x in part])
                    self.pieces.append((start, i, np.concatenate(part), at))
                start, size = i, 0
            size += 0 if own is None else len(own)

    def dot(self, weights: np.ndarray) -> np.ndarray:
        """The sum of each row's weights."""
        out = np.empty(self.n)
        for start, end, place, at in self.pieces:
            out[start:end] = np.bincount(at, weights[place], end - start)
        return out

    def spread(self, values: np.ndarray) -> np.ndarray:
        """The sum of the values of each place's rows."""
        out = np.zeros(self.space)
        for start, end, place, at in self.pieces:
            out += np.bincount(place, values[start:end][at], self.space)
        return out


@dataclass
class Chain:
    """Flagged places, and for each category the weights of all places and those of the
    number of flagged ones, earlier probabilities, intercept."""

    flagged: np.ndarray
    weights: list[tuple[np.ndarray, np.ndarray]]

    def predict(self, values: list[str]) -> list[np.ndarray]:
        """Probabilities of each category, in the order of the chain."""
        if not self.weights:
            return [np.zeros(len(values)) for _ in CATEGORIES]
        x = Rows([places_of(set(words_of(text))) for text in values])
        count = np.log1p(x.dot(self.flagged))
        made: list[np.ndarray] = []
        for places, others in self.weights:
            made.append(_probability(x.dot(places) + _beside(count, made) @ others))
        return made


def _beside(count: np.ndarray, earlier: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([count, *earlier, np.ones(len(count))])


def _probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def _fit(
    x: Rows, beside: np.ndarray, y: np.ndarray, used: np.ndarray, penalty: np.ndarray, begin: np.ndarray | None = None
) -> np.ndarray:
    """Logistic regression over the ``used`` rows with an L2 penalty for each place (1 for
    the others, none for the intercept): Newton steps, each by conjugate gradients. The
    weights of the places come first."""
    ridge = np.concatenate([penalty, np.ones(beside.shape[1] - 1), [1e-6]])
    weights = np.zeros(len(ridge)) if begin is None else begin.copy()

    def dot(w: np.ndarray) -> np.ndarray:
        return x.dot(w[: x.space]) + beside @ w[x.space :]

    def spread(v: np.ndarray) -> np.ndarray:
        return np.concatenate([x.spread(v), v @ beside])

    def loss(logit: np.ndarray, w: np.ndarray) -> float:
        return float(used @ (np.logaddexp(0, logit) - y * logit) + ridge @ (w * w) / 2)

    logit = dot(weights)
    value, first = loss(logit, weights), None
    for _ in range(30):
        p = _probability(logit)
        gradient = spread(used * (p - y)) + ridge * weights
        size = float(np.sqrt(gradient @ gradient))
        first = first or size
        if size <= 1e-3 * max(first, 0.1):
            break
        curve = used * p * (1 - p)
        scale = ridge + np.concatenate([x.spread(curve), curve @ (beside * beside)])
        step, step_logit = np.zeros(len(weights)), np.zeros(x.n)
        left = -gradient
        way = left / scale
        product = float(left @ way)
        for _ in range(20):
            way_logit = dot(way)
            bent = spread(curve * way_logit) + ridge * way
            length = product / float(way @ bent)
            step += length * way
            step_logit += length * way_logit
            left -= length * bent
            if float(np.sqrt(left @ left)) <= min(0.1, np.sqrt(size)) * size:
                break
            ahead = left / scale
            product, before = float(left @ ahead), product
            way = ahead + product / before * way
        share = 1.0
        while share > 1e-6 and (new := loss(logit + share * step_logit, weights + share * step)) > value:
            share /= 2
        if share <= 1e-6:
            break
        weights += share * step
        logit += share * step_logit
        value = new
    return weights


def fit_chain(
    odds: np.ndarray, errors: np.ndarray, places: list[np.ndarray], labels: list[bool], folds: int = FOLDS
) -> Chain:
    """A chain fitted on rows (their places and labels), given in the order that deals them
    to folds, by the places' log odds ratios and their errors."""
    chain = Chain(((odds >= np.log(ODDS)) & (odds > ERRORS * errors)).astype(float), [])
    prior = np.abs(odds) - DOUBT * errors
    live = np.flatnonzero(prior > 0)
    dense = np.full(SPACE, -1, np.int32)
    dense[live] = np.arange(len(live))
    penalty = prior[live] ** -2
    n_found = Rows(places).dot(chain.flagged)
    x = Rows([own[own >= 0] for own in (dense[p] for p in places)], len(live))
    toxic, count = np.array(labels, bool), np.log1p(n_found)
    targets = {"abusive": toxic & (n_found > 0), "severe": toxic & (n_found >= MANY), "toxic": toxic}
    fold = np.arange(x.n) % min(folds, x.n)
    earlier: list[np.ndarray] = []
    for category in CATEGORIES:
        y = targets[category].astype(float)
        beside = _beside(count, earlier)
        whole = _fit(x, beside, y, np.ones(x.n), penalty)
        weights = np.zeros(SPACE)
        weights[live] = whole[: x.space]
        chain.weights.append((weights, whole[x.space :]))
        if category == CATEGORIES[-1]:
            break
        outside = np.zeros(x.n)
        for k in range(fold.max() + 1):
            own = fold == k
            w = _fit(x, beside, y, (~own).astype(float), penalty, whole) if (~own).any() else whole
            outside[own] = _probability(x.dot(w[: x.space]) + beside @ w[x.space :])[own]
        earlier.append(outside)
    return chain


def fit(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", rows: int = ROWS,
) -> Chain:
    """A chain from ``docs`` and their ``labels``.

    Word statistics use every labelled document, copies once. The models use ``rows``
    different labelled word sets at most, the smallest by a hash; they are a table of that
    bounded size. Labels NULL or without a document do nothing; of several labels the larger
    counts. Without toxic labels or others the chain is empty and predicts 0.
    """
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull())
    known = known.groupBy(F.col(id_column).alias("_id")).agg(F.max(label_column).cast("int").alias("label"))
    source = docs.select(F.col(id_column).alias("_id"), F.col(text_column).alias("text")).where("_id IS NOT NULL")
    stage = Stage(docs.sparkSession)
    sets = stage.write(labelled_sets(source, known))
    counts = sets.mapInArrow(_place_counts, "place int, toxic long, other long")
    sums = counts.groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toArrow()
    toxic, other = np.zeros(SPACE + 1, np.int64), np.zeros(SPACE + 1, np.int64)
    at = sums["place"].to_numpy()
    toxic[at], other[at] = sums["toxic"].to_numpy(), sums["other"].to_numpy()
    t, o = int(toxic[SPACE]), int(other[SPACE])
    if not t or not o:
        stage.drop(sets)
        return Chain(np.zeros(SPACE), [])
    odds, errors = log_odds(toxic[:SPACE], other[:SPACE], t, o)
    # The smallest hashes are below a share that the number of sets gives; so what is sorted
    # is bounded as well, not only what is taken.
    share = min(1.0, (1.2 * rows + 100) / (t + o))
    drawn = F.xxhash64("words")
    low = sets.where(drawn < F.lit(int(-(2**63) + share * (2**64 - 1025))))
    taken = low.orderBy(drawn, "words", "label").limit(rows).toArrow()
    stage.drop(sets)
    places = [places_of(_unpacked(packed.as_py())) for packed in taken["words"]]
    return fit_chain(odds, errors, places, taken["label"].to_pylist())


def predict(df: DataFrame, chain: Chain, text_column: str = "text") -> DataFrame:
    """``df`` plus ``p_<category>`` for each category and ``is_toxic``.

    ``is_toxic`` means that the last category is likelier than not. NULL and empty texts
    have no words, so they get the probabilities of such a text; texts of any length
    are read whole; repeated rows are judged each. Columns of ``df`` by the new names are
    replaced; an empty table gives an empty one.
    """
    names = [f"p_{c}" for c in CATEGORIES]
    df = df.drop(*names, "is_toxic")

    def compute(batch: pa.RecordBatch) -> list[list]:
        made = [p.round(6).tolist() for p in chain.predict(texts(batch, text_column))]
        return [*made, [p >= 0.5 for p in made[-1]]]

    return extend(df, ", ".join(f"{n} double" for n in names) + ", is_toxic boolean", compute, _places.cache_clear)
