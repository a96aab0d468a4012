"""Text cleaning, tokens, n-grams and statement composition."""

from __future__ import annotations

from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from gradus.functions.folding import fold_accents, fold_for_words, fold_string, let

# White space as Python's str methods see it; Java's \s alone is ASCII.
SPACE = r"[\s\p{Z}\x{1c}-\x{1f}\x{85}]"


def strip(text: Column) -> Column:
    """Without white space at both ends (``trim`` removes blanks only)."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def squeeze(text: Column) -> Column:
    """Every run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, f"{SPACE}+", " "))


@lru_cache(maxsize=4)
def stopwords(languages: tuple[str, ...] = ("portuguese", "english")) -> tuple[str, ...]:
    """The public lists Spark ML ships, folded like the text they are compared with.

    They are kept as data of this package, one word a line, so that neither a running
    session nor a jar is needed to know them.
    """
    folder = Path(__file__).with_name("stopwords")
    words = {
        fold_string(word.strip())
        for language in languages
        for word in (folder / f"{language}.txt").read_text(encoding="utf-8").splitlines()
    }
    return tuple(sorted(words - {""}))


def clean_text(text: Column) -> Column:
    """Lower case, no code spans, no accents, only ``[a-z0-9]`` words; NULL gives ''."""
    words = F.regexp_replace(fold_for_words(lower_prose(text)), "[^a-z0-9]+", " ")
    return F.trim(words)


def lower_prose(text: Column) -> Column:
    """Lower case, no code spans; NULL gives ''."""
    spans = r"(?s)`{1,3}.*?`{1,3}"
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return let(
        lowered,
        lambda t: F.when(t.contains("`"), F.regexp_replace(t, spans, " ")).otherwise(t),
    )


def word_tokens(clean: Column, drop: tuple[str, ...] | None = None) -> Column:
    """Words of two characters or more that are not in ``drop`` (default: stop words)."""
    words = stopwords() if drop is None else drop
    kept = F.filter(F.split(clean, " "), lambda w: F.length(w) > 1)
    if not words:
        return kept
    return F.filter(kept, lambda w: ~w.isin(*words))


def clean_words(text: Column, drop: tuple[str, ...] | None = None) -> Column:
    """Cleaned text without stop words, as one string."""
    return F.array_join(word_tokens(clean_text(text), drop), " ")


def ngrams(tokens: Column, n_max: int = 2) -> Column:
    """Every 1..n_max-gram of ``tokens``, words joined by a space."""

    def windows(words: Column, n: int) -> Column:
        following = range(1, n)
        joined = F.transform(
            words, lambda w, i: F.concat_ws(" ", w, *[F.get(words, i + j) for j in following])
        )
        # The last n-1 positions have no full n-gram.
        return F.slice(joined, 1, F.greatest(F.size(words) - (n - 1), F.lit(0)))

    def grams(words: Column) -> Column:
        return F.concat(words, *[windows(words, n) for n in range(2, n_max + 1)])

    return tokens if n_max <= 1 else let(tokens, grams)


def label_key(value: Column) -> Column:
    """Lower, trimmed, folded: the form in which labels are compared."""
    return fold_accents(F.trim(F.lower(value)))


def concept_key(value: Column) -> Column:
    """``label_key`` with blanks and hyphens as underscores."""
    return F.translate(label_key(value), " -", "__")


def standard_label(value: Column) -> Column:
    """Trimmed lower-case label; the literal text ``nan`` counts as missing."""
    return F.nullif(F.lower(F.trim(value)), F.lit("nan"))


def compose_statement(
    description: Column,
    input_spec: Column,
    output_spec: Column,
    test_cases: Column | None = None,
) -> Column:
    """One statement from its parts; blank parts vanish, examples keep their number."""

    def clean(part: Column) -> Column:
        return strip(F.coalesce(part, F.lit("")))

    def titled(title: str, part: Column) -> Column:
        return let(clean(part), lambda p: F.when(p != "", F.concat(F.lit(title + "\n"), p)))

    parts = F.array(
        F.nullif(clean(description), F.lit("")),
        titled("Entrada", input_spec),
        titled("Saída", output_spec),
    )
    if test_cases is not None:

        def example(case: Column, i: Column) -> Column:
            return let(
                F.struct(clean(case["input"]).alias("i"), clean(case["output"]).alias("o")),
                lambda c: F.when(
                    (c["i"] != "") | (c["o"] != ""),
                    F.concat(
                        F.lit("Exemplo "),
                        (i + 1).cast("string"),
                        F.lit("\nEntrada: "),
                        c["i"],
                        F.lit("\nSaída: "),
                        c["o"],
                    ),
                ),
            )

        empty = F.array().cast("array<string>")
        parts = F.concat(parts, F.coalesce(F.transform(test_cases, example), empty))
    return clean(F.array_join(F.filter(parts, lambda p: p.isNotNull()), "\n\n"))


def snippet(text: Column, n: int) -> Column:
    """White space squeezed, cut to ``n`` characters, with an ellipsis if cut."""
    return let(
        squeeze(text),
        lambda t: F.concat(F.substring(t, 1, n), F.when(F.length(t) > n, "…").otherwise("")),
    )


def text_size(text: Column) -> tuple[Column, Column]:
    """(characters, white-space separated words)."""
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    return F.length(text), F.size(words)
