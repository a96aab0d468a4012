"""Level labels: rounding, scales, judge labels and free-form labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradus.functions.folding import let
from gradus.functions.text import label_key, squeeze
from gradus.schema import FIVE_TO_THREE, JUDGE_LABELS, LEVELS_5, levels

# Synonyms of the levels, and the terms searched inside longer
# answers, in this order ("very ..." terms before the plain ones).
SYNONYMS = {
    "muito facil": "muito_facil",
    "very easy": "muito_facil",
    "muito baixa": "muito_facil",
    "muito simples": "muito_facil",
    "facil": "facil",
    "easy": "facil",
    "baixa": "facil",
    "simples": "facil",
    "medio": "medio",
    "media": "medio",
    "medium": "medio",
    "moderada": "medio",
    "muito dificil": "muito_dificil",
    "very hard": "muito_dificil",
    "muito alta": "muito_dificil",
    "muito complexa": "muito_dificil",
    "dificil": "dificil",
    "hard": "dificil",
    "alta": "dificil",
    "complexa": "dificil",
}
SEARCH_ORDER = [
    "muito facil",
    "very easy",
    "muito dificil",
    "very hard",
    "facil",
    "easy",
    "medio",
    "medium",
    "media",
    "dificil",
    "hard",
]


def lookup(table: dict[str, object], key: Column) -> Column:
    """``table[key]`` as a map literal; an unknown or NULL key gives NULL."""
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.element_at(F.create_map(*pairs), key)


def round_half_up(value: Column) -> Column:
    """2.5 becomes 3 (``bround`` would give 2)."""
    return F.floor(value + 0.5).cast("int")


def level_of(note: Column) -> Column:
    """The 5-level label of a note, clamped to 1..5."""
    clamped = F.greatest(F.lit(1), F.least(F.lit(5), note.cast("int")))
    return F.when(note.isNotNull(), F.element_at(F.array(*map(F.lit, LEVELS_5)), clamped))


def note_of(label: Column, n_levels: int = 5) -> Column:
    """1-based position of a label on its scale; unknown gives NULL."""
    names = levels(n_levels)
    return lookup({name: i for i, name in enumerate(names, 1)}, label)


def label_by(strategy: str, mean: Column, mode: Column) -> Column:
    """Label from the rounded mean (``mean``) or from the mode (``mode``)."""
    if strategy == "mean":
        return level_of(round_half_up(mean))
    if strategy == "mode":
        return level_of(mode)
    raise ValueError(f"unknown label strategy: {strategy!r}; use 'mean' or 'mode'")


def collapse(label: Column, keep_unknown: bool = False) -> Column:
    """5 levels to 3. Unknown labels become NULL, or pass through for catalogs."""
    known = lookup(FIVE_TO_THREE, label)
    return F.coalesce(known, label) if keep_unknown else known


def judge_label(raw: Column, table: dict[str, str] | None = None) -> Column:
    """A judge's own label on our scale; blank or unknown gives NULL."""
    return lookup(table or JUDGE_LABELS, label_key(raw))


def parse_label(answer: Column) -> Column:
    """Any spelling of a level ('Very Hard', 'muito-fácil', 'seria difícil')."""
    text = F.translate(label_key(F.coalesce(answer, F.lit(""))), "_-", "  ")
    text = squeeze(text)

    def parse(t: Column) -> Column:
        inside = F.when(t.contains(SEARCH_ORDER[0]), SYNONYMS[SEARCH_ORDER[0]])
        for term in SEARCH_ORDER[1:]:
            inside = inside.when(t.contains(term), SYNONYMS[term])
        return F.coalesce(lookup(SYNONYMS, t), inside, F.translate(t, " ", "_"))

    return let(text, parse)


def level_relation(query_note: Column, candidate_note: Column) -> Column:
    """Where the candidate stands: below, above, same or unknown."""
    return (
        F.when(query_note.isNull() | candidate_note.isNull(), "unknown")
        .when(candidate_note < query_note, "below")
        .when(candidate_note > query_note, "above")
        .otherwise("same")
    )


def level_gap(query_note: Column, candidate_note: Column) -> Column:
    """Signed distance in levels; NULL when one of them is unknown."""
    return candidate_note - query_note
