"""The same results in plain SQL, for a second engine to check.

Written from the definitions of the operators, with ordinary windows, cross joins and
correlated steps that would not scale: it only has to be right on small tables.
"""

from __future__ import annotations

from functools import lru_cache

from gradus.functions.labels import SEARCH_ORDER, SYNONYMS
from gradus.functions.text import stopwords
from gradus.schema import CONCEPTS, FIVE_TO_THREE, JUDGE_LABELS, LEVELS_3, LEVELS_5
from workload.views import JUDGE_SPELLING, SETTINGS


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


SPACE = r"[\s\p{Z}\x{0b}\x{1c}-\x{1f}\x{85}]"


def _clean(text: str) -> str:
    spans = rf"regexp_replace(lower(coalesce({text}, '')), '(?s)`{{1,3}}.*?`{{1,3}}', ' ', 'g')"
    words = rf"regexp_replace(strip_accents({spans}), '[^a-z0-9\s]', ' ', 'g')"
    return rf"trim(regexp_replace({words}, '\s+', ' ', 'g'))"


def _words(text: str) -> str:
    return (
        f"list_filter(string_split({_clean(text)}, ' '), "
        f"lambda w: length(w) > 1 AND NOT list_contains({_list(stopwords())}, w))"
    )


def _strip(text: str) -> str:
    return rf"regexp_replace({text}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def _squeeze(text: str) -> str:
    return rf"trim(regexp_replace({text}, '{SPACE}+', ' ', 'g'))"


def _key(text: str) -> str:
    return f"strip_accents(trim(lower({text})))"


def _case(expr: str, pairs: dict, other: str = "NULL") -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {expr} {whens} ELSE {other} END"


def _ordinal(label: str, scale: list[str]) -> str:
    whens = " ".join(f"WHEN '{name}' THEN {i}" for i, name in enumerate(scale, 1))
    return f"CASE {label} {whens} END"


def _level_name(position: str) -> str:
    return f"({_list(LEVELS_5)})[{position}]"


def _vote_order(seed_cols: str = "id") -> str:
    return f"md5('42:' || CAST({seed_cols} AS VARCHAR)), {seed_cols}"


# --- shared steps -------------------------------------------------------------

DOCS = "docs AS (SELECT doc_id AS id, source, lang, text, n_chars FROM documents)"

CUTS = """cuts AS (SELECT quantile_cont(n_chars, [0.2, 0.4, 0.6, 0.8]) AS q
  FROM docs WHERE id IN (SELECT doc_id FROM labels))"""

LABELLED = f"""{DOCS}, {CUTS},
labelled AS (SELECT d.id, d.source, d.lang, d.text, d.n_chars,
  CASE WHEN l.doc_id IS NOT NULL THEN {_level_name(
      "1 + CAST(d.n_chars > c.q[1] AS INT) + CAST(d.n_chars > c.q[2] AS INT) "
      "+ CAST(d.n_chars > c.q[3] AS INT) + CAST(d.n_chars > c.q[4] AS INT)")} END AS label
  FROM docs d CROSS JOIN cuts c LEFT JOIN labels l ON l.doc_id = d.id)"""

TRAIN5 = "train AS (SELECT id, text, label FROM labelled WHERE label IS NOT NULL)"
TRAIN3 = f"train AS (SELECT id, text, {_case('label', FIVE_TO_THREE)} AS label FROM labelled WHERE label IS NOT NULL)"

FOLDS = f"""sizes AS (SELECT min(n) AS smallest, count(*) AS classes
  FROM (SELECT count(*) AS n FROM train GROUP BY label)),
folded AS (SELECT t.id, t.text, t.label, CAST((row_number() OVER (
    PARTITION BY CASE WHEN s.smallest >= 2 THEN t.label ELSE '' END ORDER BY {_vote_order('t.id')}) - 1)
  % (CASE WHEN s.smallest >= 2 THEN greatest(2, least(5, s.smallest))
     ELSE greatest(2, least(5, greatest(2, s.classes))) END) AS INTEGER) AS fold
  FROM train t CROSS JOIN sizes s)"""

SPLIT = f"""sizes AS (SELECT min(n) AS smallest FROM (SELECT count(*) AS n FROM train GROUP BY label)),
ranked AS (SELECT t.id, t.text, t.label,
    row_number() OVER (PARTITION BY CASE WHEN s.smallest >= 2 THEN t.label ELSE '' END
      ORDER BY {_vote_order('t.id')}) AS rn,
    count(*) OVER (PARTITION BY CASE WHEN s.smallest >= 2 THEN t.label ELSE '' END) AS size
  FROM train t CROSS JOIN sizes s),
split AS (SELECT id, text, label, rn <= ceil(size * 0.2::DOUBLE) AS is_test FROM ranked)"""


def _word_table(name: str, source: str, text: str = "text", extra: str = "") -> str:
    return f"{name} AS (SELECT id{extra}, {_words(text)} AS words FROM {source} WHERE text IS NOT NULL AND trim(text) <> '')"


def _terms(name: str, words: str, ngram: int = 2, extra: str = "") -> str:
    grams = "words"
    if ngram == 2:
        grams = (
            "list_concat(words, list_transform(range(1, len(words)), "
            "lambda i: words[i] || ' ' || words[i + 1]))"
        )
    return (
        f"{name} AS (SELECT id{extra}, term, count(*) AS tf FROM "
        f"(SELECT id{extra}, unnest({grams}) AS term FROM {words} WHERE len(words) > 0) "
        f"GROUP BY ALL)"
    )


def _vocab(name: str, terms: str, words: str) -> str:
    """Vocabulary of a corpus, with its weights."""
    return f"""{name} AS (SELECT term, total, df,
    ln((1.0::DOUBLE + (SELECT count(*) FROM {words} WHERE len(words) > 0)) / (1 + df)) + 1 AS idf
  FROM (SELECT term, CAST(sum(tf) AS BIGINT) AS total, count(*) AS df FROM {terms} GROUP BY term
    HAVING count(*) >= 2 ORDER BY total DESC, term LIMIT 5000))"""


def _weights(name: str, terms: str, vocab: str, key: str = "id") -> str:
    return f"""{name} AS (SELECT {key}, term, x / sqrt(sum(x * x) OVER (PARTITION BY {key})) AS w
  FROM (SELECT t.{key}, t.term, t.tf * v.idf AS x FROM {terms} t JOIN {vocab} v USING (term)))"""


def _corpus(source: str = "docs", ngram: int = 2) -> str:
    """stops, doc_words, doc_terms, vocab, doc_w."""
    return ",\n".join(
        [
            _word_table("doc_words", source),
            _terms("doc_terms", "doc_words", ngram),
            _vocab("vocab", "doc_terms", "doc_words"),
            _weights("doc_w", "doc_terms", "vocab"),
        ]
    )


NEW = """new AS (SELECT item_id AS id, text,
  CASE WHEN item_id % 7 <> 0 THEN CAST(item_id % 3 + 1 AS INTEGER) END AS level FROM benchmark)"""

NEW_W = ",\n".join(
    [
        _word_table("new_words", "new"),
        _terms("new_terms", "new_words"),
        _weights("new_w", "new_terms", "vocab"),
    ]
)

COSINE = """usable AS (SELECT d.id, d.source FROM docs d JOIN doc_words w USING (id) WHERE len(w.words) > 0),
dots AS (SELECT q.id AS query, d.id AS id, sum(q.w * d.w) AS dot
  FROM new_w q JOIN doc_w d USING (term) GROUP BY ALL),
pairs AS (SELECT n.id AS query, n.level AS qlevel, c.id, c.source, coalesce(dots.dot, 0) AS exact,
    round(coalesce(dots.dot, 0), 6) AS cosine
  FROM new n CROSS JOIN usable c LEFT JOIN dots ON dots.query = n.id AND dots.id = c.id)"""


def _dictionary() -> str:
    number = f"CAST('0x' || substr(md5(term), 1, 7) AS BIGINT) % {len(CONCEPTS)}"
    return f"""dictionary AS (SELECT term AS word, ({_list(CONCEPTS)})[1 + {number}] AS concept
  FROM ({_inline_unigrams()}) GROUP BY term HAVING count(*) >= 2)"""


def _inline_unigrams() -> str:
    return "SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(words) AS term FROM doc_words) GROUP BY ALL"


def _tags(name: str, words: str) -> str:
    return f"""{name} AS (SELECT w.id, coalesce(list_sort(list(DISTINCT d.concept) FILTER (d.concept IS NOT NULL)), []) AS concepts
  FROM (SELECT id, unnest(CASE WHEN len(words) = 0 THEN [''] ELSE words END) AS word FROM {words}) w
  LEFT JOIN dictionary d USING (word) GROUP BY w.id)"""


def _both(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b}))"


def _jaccard(a: str, b: str) -> str:
    both = _both(a, b)
    return (
        f"CASE WHEN len({a}) + len({b}) > 0 THEN {both}::DOUBLE / (len({a}) + len({b}) - {both}) ELSE 0.0::DOUBLE END"
    )


# Text recommendations: scored pairs with levels and concepts.
CATALOG_LEVEL = f"levels AS (SELECT id, {_ordinal(_case('label', FIVE_TO_THREE, 'label'), LEVELS_3)} AS level FROM labelled)"


def _text_pairs() -> str:
    return ",\n".join(
        [
            LABELLED,
            CATALOG_LEVEL,
            _corpus(),
            NEW,
            NEW_W,
            _dictionary(),
            _tags("doc_tags", "doc_words"),
            _tags("new_tags", "new_words"),
            COSINE,
            f"""scored AS (SELECT p.query, p.qlevel, p.id, p.source, p.cosine, l.level,
    {_jaccard('qt.concepts', 'dt.concepts')} AS jaccard,
    round(CASE WHEN len(qt.concepts) > 0
      THEN 0.7::DOUBLE * {_jaccard('qt.concepts', 'dt.concepts')} + (1 - 0.7::DOUBLE) * p.exact
      ELSE p.exact END, 6) AS score
  FROM pairs p JOIN levels l USING (id) JOIN doc_tags dt ON dt.id = p.id JOIN new_tags qt ON qt.id = p.query)""",
        ]
    )


HISTORY = """history AS (SELECT DISTINCT e.user_id AS query, d.id, d.source
  FROM events e JOIN docs d ON d.id = e.event_id % (SELECT count(*) FROM documents)
  WHERE e.event_type = 'purchase'),
users AS (SELECT DISTINCT user_id AS query, CAST(user_id % 3 + 1 AS INTEGER) AS level FROM events)"""


USER_LEVEL = f"""placed AS (SELECT query, coalesce(name, '{LEVELS_3[0]}') AS level_name FROM (
  SELECT h.query, CASE WHEN l.level IS NOT NULL THEN ({_list(LEVELS_3)})[l.level] END AS name,
    row_number() OVER (PARTITION BY h.query ORDER BY CASE WHEN l.level IS NULL THEN 1 ELSE 0 END, count(*) DESC,
      CASE WHEN l.level IS NOT NULL THEN ({_list(LEVELS_3)})[l.level] END) AS rn
  FROM history h JOIN levels l USING (id) GROUP BY h.query, l.level) WHERE rn = 1),
user_levels AS (SELECT u.query, p.level_name, {_ordinal('p.level_name', LEVELS_3)} AS level
  FROM (SELECT query FROM users) u LEFT JOIN placed p USING (query))"""


def _history_topk(levels: str) -> str:
    return f"""WITH {LABELLED}, {CATALOG_LEVEL}, {_corpus()}, {_dictionary()}, {_tags('doc_tags', 'doc_words')},
{HISTORY}, {USER_LEVEL},
sums AS (SELECT h.query, d.term, sum(d.w) AS w FROM history h JOIN doc_w d USING (id) GROUP BY ALL),
profile AS (SELECT query, term, w / sqrt(sum(w * w) OVER (PARTITION BY query)) AS w FROM sums),
wanted AS (SELECT query, list(DISTINCT c) AS concepts FROM (
  SELECT h.query, unnest(t.concepts) AS c FROM history h JOIN doc_tags t USING (id)) GROUP BY query),
dots AS (SELECT p.query, d.id, sum(p.w * d.w) AS dot FROM profile p JOIN doc_w d USING (term) GROUP BY ALL),
pairs AS (SELECT u.query, u.level AS qlevel, d.id, d.source, l.level, coalesce(x.dot, 0) AS exact,
    coalesce(w.concepts, []) AS wanted, t.concepts
  FROM {levels} u CROSS JOIN (SELECT docs.* FROM docs JOIN doc_words w USING (id) WHERE len(w.words) > 0) d JOIN levels l USING (id) JOIN doc_tags t USING (id)
  LEFT JOIN wanted w USING (query)
  LEFT JOIN dots x ON x.query = u.query AND x.id = d.id
  ANTI JOIN history h ON h.query = u.query AND h.id = d.id),
scored AS (SELECT query, id, source, round(CASE WHEN len(wanted) > 0
    THEN 0.7::DOUBLE * {_jaccard('wanted', 'concepts')} + (1 - 0.7::DOUBLE) * exact ELSE exact END, 6) AS score
  FROM pairs WHERE qlevel IS NULL OR abs(level - qlevel) <= 1)
SELECT query, rank, source, id, score FROM (SELECT *, CAST(row_number() OVER (
  PARTITION BY query ORDER BY score DESC, source, id) AS INTEGER) AS rank FROM scored) WHERE rank <= 5"""


RATINGS = "ratings AS (SELECT l_partkey AS question_id, 1 + (CAST(l_quantity AS INT) - 1) % 5 AS rating FROM lineitem)"


def _summary(source: str, strategy: str) -> str:
    note = "CAST(floor(mean + 0.5) AS INT)" if strategy == "mean" else "mode_rating"
    label = _level_name(f"greatest(1, least(5, {note}))")
    return f"""counts AS (SELECT question_id AS id, rating, count(*) AS f FROM {source} GROUP BY ALL),
means AS (SELECT id, rating, f, sum(rating * f) OVER (PARTITION BY id)::DOUBLE / sum(f) OVER (PARTITION BY id) AS mean,
  sum(f) OVER (PARTITION BY id) AS n FROM counts),
modes AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY f DESC, abs(rating - mean), rating) AS rn FROM means),
summary AS (SELECT id, n_ratings, round(mean, 3) AS mean_rating, mode_rating, {label} AS label FROM (
  SELECT id, CAST(n AS INTEGER) AS n_ratings, mean, CAST(rating AS INTEGER) AS mode_rating FROM modes WHERE rn = 1))"""


RATED_PARTS = f"""{RATINGS}, rated AS (SELECT * FROM ratings WHERE question_id % 3 <> 0), {_summary('rated', 'mean')},
base AS (SELECT p_partkey AS id, p_name AS text, coalesce(n_ratings, 0) AS n_ratings, mean_rating, mode_rating, label
  FROM part LEFT JOIN summary ON summary.id = part.p_partkey)"""

JUDGED = f"judged AS (SELECT o_orderkey AS id, {_case('o_orderpriority', JUDGE_SPELLING)} AS raw_label FROM orders)"
JUDGE_LABEL = _case(_key("raw_label"), JUDGE_LABELS)

PREDICTIONS = f"""{LABELLED},
train AS (SELECT id, lang AS text, {_case('label', FIVE_TO_THREE)} AS label FROM labelled WHERE label IS NOT NULL), {FOLDS},
outside AS (SELECT f.fold, t.label AS pred, count(*) FILTER (t.fold <> f.fold) AS n
  FROM (SELECT DISTINCT fold FROM folded) f CROSS JOIN folded t GROUP BY ALL),
majority AS (SELECT fold, pred FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY n DESC, pred) AS rn
  FROM outside) WHERE rn = 1),
predictions AS (
  SELECT 'majority' AS model, fold, id, label, pred FROM folded JOIN majority USING (fold)
  UNION ALL SELECT 'language', fold, id, label,
    CASE text WHEN 'en' THEN 'facil' WHEN 'de' THEN 'medio' ELSE 'dificil' END FROM folded)"""


def _per_class(by: str, predictions: str = "predictions") -> str:
    return f"""sides AS (
  SELECT {by}, label, 1 AS support, 0 AS guessed, CASE WHEN label = pred THEN 1 ELSE 0 END AS hit FROM {predictions}
  UNION ALL SELECT {by}, pred, 0, 1, 0 FROM {predictions}),
totals AS (SELECT {by}, label, sum(support) AS support, sum(guessed) AS guessed, sum(hit) AS hit FROM sides GROUP BY {by}, label),
classes AS (SELECT {by}, label, support, hit,
  CASE WHEN guessed > 0 THEN hit::DOUBLE / guessed ELSE 0.0::DOUBLE END AS precision,
  CASE WHEN support > 0 THEN hit::DOUBLE / support ELSE 0.0::DOUBLE END AS recall,
  CASE WHEN guessed + support > 0 THEN 2.0::DOUBLE * hit / (guessed + support) ELSE 0.0::DOUBLE END AS f1 FROM totals),
measures AS (SELECT {by}, sum(hit)::DOUBLE / sum(support) AS accuracy, avg(f1) AS f1_macro,
  sum(f1 * support)::DOUBLE / sum(support) AS f1_weighted FROM classes GROUP BY {by})"""


GUESS5 = "CASE lang WHEN 'en' THEN 'facil' WHEN 'de' THEN 'medio' ELSE 'muito_dificil' END"
SOURCE_METRICS = f"""{LABELLED},
five AS (SELECT source, 'language' AS model, label, {GUESS5} AS pred FROM labelled WHERE label IS NOT NULL
  UNION ALL SELECT source, 'always_medio', label, 'medio' FROM labelled WHERE label IS NOT NULL),
predictions AS (SELECT source, 5 AS n_levels, model, label, pred FROM five
  UNION ALL SELECT source, 3, model, {_case('label', FIVE_TO_THREE)}, {_case('pred', FIVE_TO_THREE)} FROM five),
{_per_class('source, n_levels, model')},
board AS (SELECT source, n_levels, model, round(accuracy, 6) AS accuracy, round(f1_macro, 6) AS f1_macro,
  round(f1_weighted, 6) AS f1_weighted FROM measures),
placed AS (SELECT *, CAST(row_number() OVER (PARTITION BY source, n_levels ORDER BY f1_macro DESC, model) AS INTEGER) AS place FROM board)"""

SIZED = rf"""{LABELLED},
sized AS (SELECT id, label, text, length(text) AS n_characters,
  len(list_filter(regexp_split_to_array(text, '{SPACE}+'), lambda w: w <> '')) AS n_words FROM labelled)"""

LABEL_CACHE = """cache AS (SELECT doc_id AS id, 'medio' AS pred, 1 AS run FROM labels
  UNION ALL SELECT doc_id, CASE WHEN quality = 1 THEN 'facil' ELSE 'dificil' END, 2 FROM labels),
aligned AS (SELECT d.doc_id AS id, d.source, c.pred FROM documents d LEFT JOIN (
  SELECT id, pred FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY run DESC) AS rn FROM cache) WHERE rn = 1) c
  ON c.id = d.doc_id)"""


def _profile_row(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 6) AS mean,
  round(stddev_samp({column}), 6) AS std, round(min({column})::DOUBLE, 6) AS min,
  round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50,
  round(quantile_cont({column}, 0.75), 6) AS q75, round(max({column})::DOUBLE, 6) AS max FROM sized"""


def _freeform() -> str:
    first = ["", "Muito ", "very_", "seria  ", "nível-", "VERY "]
    second = ["Fácil", "easy", "MÉDIO", "Medium", "difícil", "hard", "alta", "simples", "xyz abc"]
    inside = " ".join(f"WHEN contains(k, '{t}') THEN '{SYNONYMS[t]}'" for t in SEARCH_ORDER)
    return f"""WITH counted AS (SELECT ({_list(first)})[1 + l_orderkey % 6] || ({_list(second)})[1 + l_partkey % 9] AS answer,
  count(*) AS n FROM lineitem GROUP BY 1),
keyed AS (SELECT *, trim(regexp_replace(replace(replace({_key('answer')}, '_', ' '), '-', ' '), '\\s+', ' ', 'g')) AS k FROM counted)
SELECT answer, coalesce({_case('k', SYNONYMS)}, CASE {inside} END, replace(k, ' ', '_')) AS label, n FROM keyed"""


def _prompt_head() -> str:
    return f'Allowed values: {", ".join(CONCEPTS)}.\nReply in JSON with the field "conceitos".\n\n'


def _oracles() -> dict[str, str]:
    plain_top = "CAST(row_number() OVER (PARTITION BY query ORDER BY {order}) AS INTEGER)"
    score_rank = plain_top.format(order="score DESC, source, id")
    sql: dict[str, str] = {}

    sql["catalog_union_totals"] = f"""WITH {LABELLED},
u AS (SELECT 'documents' AS source, id, text, label FROM labelled
  UNION ALL SELECT 'benchmark', item_id, text, NULL FROM benchmark
  UNION ALL SELECT 'conversations', conv_id * 1000 + turn, text, NULL FROM conversations WHERE role = 'user')
SELECT source, count(*) AS n, count(label) AS labelled, CAST(sum(id) AS BIGINT) AS id_sum,
  CAST(sum(length(text)) AS BIGINT) AS chars FROM u GROUP BY source"""
    sql["input_contract"] = f"""WITH {LABELLED},
u AS (SELECT id, text, label FROM labelled UNION ALL SELECT item_id, nullif(text, ''), 'unrated' FROM benchmark)
SELECT count(*) AS rows, count(*) FILTER (id IS NULL) AS null_keys,
  count(id) - count(DISTINCT id) AS duplicate_keys,
  count(*) FILTER (text IS NULL) AS null_text,
  count(*) FILTER (text IS NOT NULL AND trim(text) = '') AS blank_text,
  count(*) FILTER (label IS NOT NULL AND NOT list_contains({_list(LEVELS_5)}, label)) AS odd_labels FROM u"""
    sql["json_array_repair"] = """SELECT event_id, 2 AS n_items, CAST(props->>'k' AS BIGINT) AS first_k,
  CAST(props->>'k' AS BIGINT) - 1 AS sum_k FROM events"""

    sql["clean_text_plain"] = f"SELECT doc_id AS id, {_clean('text')} AS clean FROM documents"
    sql["clean_text_stopwords"] = (
        f"SELECT doc_id AS id, array_to_string({_words('text')}, ' ') AS clean FROM documents"
    )
    sql["compose_statements"] = f"""WITH {DOCS},
lines AS (SELECT *, string_split(text, chr(10)) AS ls FROM docs),
ex AS (SELECT *, list_filter(list_transform(ls, lambda x, i: CASE
    WHEN (i - 1) % 3 = 0 AND {_strip('x')} || {_strip('x')} <> '' THEN
      'Exemplo ' || CAST(i AS VARCHAR) || chr(10) || 'Entrada: ' || {_strip('x')} || chr(10) || 'Saída: ' || {_strip('x')}
    WHEN (i - 1) % 3 = 2 AND {_strip('x')} <> '' THEN
      'Exemplo ' || CAST(i AS VARCHAR) || chr(10) || 'Entrada: ' || {_strip('x')} || chr(10) || 'Saída: ' END),
  lambda p: p IS NOT NULL) AS cases FROM lines),
parts AS (SELECT id, list_filter(list_concat([nullif({_strip('ls[1]')}, ''),
    CASE WHEN id % 2 = 0 AND {_strip('lang')} <> '' THEN 'Entrada' || chr(10) || {_strip('lang')} END,
    CASE WHEN {_strip('source')} <> '' THEN 'Saída' || chr(10) || {_strip('source')} END], cases),
  lambda p: p IS NOT NULL) AS ps FROM ex)
SELECT id, {_strip("array_to_string(ps, chr(10) || chr(10))")} AS statement FROM parts"""
    sql["label_freeform"] = _freeform()
    sql["text_snippet"] = f"""WITH s AS (SELECT doc_id AS id, {_squeeze('text')} AS t FROM documents)
SELECT id, substring(t, 1, 90) || CASE WHEN length(t) > 90 THEN '…' ELSE '' END AS snippet FROM s"""
    sql["text_sizes"] = f"WITH {SIZED} SELECT id, CAST(n_characters AS INTEGER) AS n_characters, CAST(n_words AS INTEGER) AS n_words FROM sized"

    for name in ("mean", "mode"):
        sql[f"rating_label_{name}"] = f"WITH {RATINGS}, {_summary('ratings', name)} SELECT * FROM summary"
    sql["statements_with_ratings"] = f"WITH {RATED_PARTS} SELECT * FROM base"
    sql["judge_labels"] = f"""WITH {JUDGED}, l AS (SELECT id, {JUDGE_LABEL} AS label FROM judged),
n AS (SELECT *, {_ordinal('label', LEVELS_5)} AS note FROM l)
SELECT id, CASE WHEN label IS NULL THEN 0 ELSE 1 END AS n_ratings, CAST(note AS DOUBLE) AS mean_rating,
  CAST(note AS INTEGER) AS mode_rating, label FROM n"""
    sql["unmapped_labels"] = f"""WITH {JUDGED} SELECT trim(raw_label) AS raw_label, count(*) AS n FROM judged
WHERE trim(raw_label) <> '' AND {JUDGE_LABEL} IS NULL GROUP BY 1"""
    sql["first_record_by_id"] = """SELECT id, l_orderkey, l_quantity FROM (SELECT l_partkey AS id, l_orderkey, l_quantity,
  row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_quantity) AS rn FROM lineitem) WHERE rn = 1"""
    sql["collapse_levels"] = f"""WITH {LABELLED},
x AS (SELECT id, CASE WHEN id % 10 = 0 THEN 'outro' ELSE label END AS label FROM labelled)
SELECT id, label, {_case('label', FIVE_TO_THREE)} AS for_training, {_case('label', FIVE_TO_THREE, 'label')} AS for_catalog FROM x"""

    sql["class_distribution"] = f"""WITH {LABELLED}, c AS (SELECT label, count(*) AS n FROM labelled WHERE label IS NOT NULL GROUP BY 1)
SELECT CAST({_ordinal('label', LEVELS_5)} AS INTEGER) AS level, label, n,
  round(n * 100::DOUBLE / sum(n) OVER (), 1) AS pct FROM c"""
    sql["source_totals"] = f"""WITH {LABELLED} SELECT source, count(*) AS n, count(label) AS labelled,
  count(*) - count(label) AS unlabelled FROM labelled GROUP BY 1"""
    sql["null_profile"] = f"WITH {RATED_PARTS} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS n_null FROM base"
        for c in ("id", "text", "n_ratings", "mean_rating", "mode_rating", "label")
    )
    sql["numeric_profile"] = f"WITH {SIZED} {_profile_row('n_characters')} UNION ALL {_profile_row('n_words')}"
    sql["histogram_40"] = f"""WITH {SIZED}, e AS (SELECT min(n_characters)::DOUBLE AS lo, max(n_characters)::DOUBLE AS hi FROM sized),
b AS (SELECT least(39, CAST(floor((n_characters - lo) / ((hi - lo) / 40)) AS INT)) AS bin, count(*) AS n FROM sized, e GROUP BY 1)
SELECT CAST(r.range AS INTEGER) AS bin, round(lo + r.range * ((hi - lo) / 40), 6) AS low,
  round(lo + (r.range + 1) * ((hi - lo) / 40), 6) AS high, coalesce(n, 0) AS n
FROM range(40) r CROSS JOIN e LEFT JOIN b ON b.bin = r.range"""
    sql["boxplot_by_level"] = f"""WITH {SIZED},
q AS (SELECT label, quantile_cont(n_words, [0.25, 0.5, 0.75]) AS q FROM sized WHERE label IS NOT NULL GROUP BY 1),
x AS (SELECT s.label, s.n_words, q.q, s.n_words BETWEEN q.q[1] - 1.5 * (q.q[3] - q.q[1]) AND q.q[3] + 1.5 * (q.q[3] - q.q[1]) AS inside
  FROM sized s JOIN q USING (label))
SELECT label, count(*) AS n, any_value(q[1])::DOUBLE AS q25, any_value(q[2])::DOUBLE AS q50, any_value(q[3])::DOUBLE AS q75,
  min(n_words) FILTER (inside)::DOUBLE AS whisker_low, max(n_words) FILTER (inside)::DOUBLE AS whisker_high,
  count(*) FILTER (NOT inside) AS n_outliers FROM x GROUP BY label"""
    sql["first_example"] = f"""WITH {LABELLED} SELECT label, id, text AS example FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY id) AS rn FROM labelled WHERE label IS NOT NULL) WHERE rn = 1"""

    sql["vocabulary"] = f"WITH {DOCS}, {_corpus()} SELECT term, total, df FROM vocab"
    sql["tfidf_unigrams"] = f"WITH {DOCS}, {_corpus(ngram=1)} SELECT id, term, round(w, 6) AS w FROM doc_w"
    sql["tfidf_bigrams"] = f"WITH {DOCS}, {_corpus()} SELECT id, term, round(w, 6) AS w FROM doc_w"
    sql["tfidf_transform"] = f"WITH {DOCS}, {_corpus()}, {NEW}, {NEW_W} SELECT id, term, round(w, 6) AS w FROM new_w"
    sql["fold_document_frequency"] = f"""WITH {LABELLED}, {TRAIN3}, {FOLDS}, {_word_table('fold_words', 'folded', extra=', fold')}, {_terms('fold_terms', 'fold_words', 1, ', fold')}
SELECT f.fold, t.term, CAST(sum(t.tf) AS BIGINT) AS total, count(*) AS df
FROM (SELECT DISTINCT fold FROM folded) f JOIN fold_terms t ON t.fold <> f.fold GROUP BY ALL"""

    base = f"WITH {DOCS}, {_corpus()}, {NEW}, {NEW_W}, {COSINE}"
    cos_rank = plain_top.format(order="cosine DESC, source, id")
    sql["similar_topk"] = f"""{base} SELECT query, rank, source, id, cosine AS score FROM (
  SELECT *, {cos_rank} AS rank FROM pairs) WHERE rank <= 5"""
    sql["near_duplicates"] = f"""{base}, hits AS (SELECT *, count(*) OVER (PARTITION BY query) AS n,
    row_number() OVER (PARTITION BY query ORDER BY source, id) AS rn FROM pairs WHERE cosine >= 0.3)
SELECT query, n, source, id FROM hits WHERE rn = 1"""
    classes = f"""WITH {DOCS}, {_corpus()},
keys AS (SELECT id, string_agg(term || ':' || round(w, 9), ' ' ORDER BY term) AS k FROM doc_w GROUP BY id),
named AS (SELECT id, source, first_value(id) OVER by_key AS class_id, first_value(source) OVER by_key AS class_source
  FROM keys JOIN docs USING (id) WINDOW by_key AS (PARTITION BY k ORDER BY source, id))"""
    sql["near_duplicate_classes"] = f"{classes} SELECT source, id, class_source, class_id FROM named"
    sql["near_duplicate_pairs"] = f"""{classes}, firsts AS (SELECT n.id, n.source, d.term, d.w FROM named n JOIN doc_w d USING (id)
  WHERE n.id = n.class_id AND n.source = n.class_source)
SELECT a.source, a.id, b.source AS other_source, b.id AS other_id, round(sum(a.w * b.w), 6) AS cosine
FROM firsts a JOIN firsts b ON a.term = b.term AND (a.source < b.source OR (a.source = b.source AND a.id < b.id))
GROUP BY ALL HAVING round(sum(a.w * b.w), 6) >= 0.95"""
    tags = f"{_dictionary()}, {_tags('doc_tags', 'doc_words')}"
    sql["concept_jaccard"] = f"""WITH {DOCS}, {_word_table('doc_words', 'docs')}, {tags}, {NEW},
{_word_table('new_words', 'new')}, {_tags('new_tags', 'new_words')}
SELECT q.id AS query, round({_jaccard('q.concepts', 'd.concepts')}, 6) AS jaccard, count(*) AS n
FROM new_tags q CROSS JOIN doc_tags d GROUP BY ALL"""
    pairs = f"WITH {_text_pairs()}"
    sql["blended_topk"] = f"""{pairs} SELECT query, rank, source, id, score, cosine, round(jaccard, 6) AS jaccard FROM (
  SELECT *, {score_rank} AS rank FROM scored) WHERE rank <= 5"""
    in_window = "(qlevel IS NULL OR abs(level - qlevel) <= 1)"
    text_top = f"""SELECT query, rank, source, id, score FROM (SELECT *, {score_rank} AS rank FROM scored
  WHERE cosine < 0.95 AND {in_window}) WHERE rank <= """
    sql["recommend_text"] = f"{pairs} {text_top}5"
    sql["recommend_string"] = f"""{pairs}, top AS ({text_top}5)
SELECT query, string_agg(CAST(id AS VARCHAR) || '(' || source || ')', '; ' ORDER BY rank) AS recommendations FROM top GROUP BY query"""
    sql["recommend_reasons"] = f"""{pairs}, top AS ({text_top}3),
r AS (SELECT t.query, t.rank, t.source, t.id, list_sort(list_intersect(qt.concepts, dt.concepts)) AS common,
    n.level AS ql, l.level AS il
  FROM top t JOIN new n ON n.id = t.query JOIN levels l ON l.id = t.id
  JOIN new_tags qt ON qt.id = t.query JOIN doc_tags dt ON dt.id = t.id)
SELECT query, rank, source, id, CASE WHEN len(common) = 0 THEN 'conteúdo similar' ELSE array_to_string(common, ', ') END AS concepts,
  CASE WHEN ql IS NULL OR il IS NULL THEN 'unknown' WHEN il < ql THEN 'below' WHEN il > ql THEN 'above' ELSE 'same' END AS relation,
  CAST(il - ql AS INTEGER) AS gap FROM r"""
    sql["recommend_relaxed"] = f"""{pairs},
w AS (SELECT *, coalesce(qlevel IS NULL OR nullif(level, 3) = qlevel, false) AS in_window FROM scored WHERE cosine < 0.95),
k AS (SELECT *, bool_or(in_window) OVER (PARTITION BY query) AS hit FROM w)
SELECT query, rank, source, id, score, in_window FROM (SELECT *, {score_rank} AS rank FROM k WHERE in_window = hit) WHERE rank <= 3"""
    guess = f"CASE lang WHEN 'en' THEN 1 WHEN 'de' THEN 2 ELSE 3 END"
    sql["recommend_effective"] = f"""{pairs},
filled AS (SELECT s.* EXCLUDE (level), CAST(coalesce(s.level, {guess}) AS INTEGER) AS level, d.text FROM scored s JOIN docs d USING (id)),
top AS (SELECT *, {score_rank} AS rank FROM filled WHERE cosine < 0.95 AND {in_window})
SELECT query, rank, source, t.id, md5(text) AS text_md5, ({_list(LEVELS_3)})[level] AS effective, score,
  array_to_string(dt.concepts, ', ') AS concepts FROM top t JOIN doc_tags dt ON dt.id = t.id WHERE rank <= 5"""
    sql["chosen_queries"] = """SELECT doc_id AS id, source, md5(text) AS text_md5 FROM documents
WHERE source = 'src3' AND doc_id NOT IN (SELECT doc_id FROM labels) ORDER BY doc_id LIMIT 25"""
    sql["catalog_concepts"] = f"""WITH {DOCS}, {_word_table('doc_words', 'docs')}, {tags},
items AS (SELECT id, source FROM docs UNION ALL SELECT item_id, 'benchmark' FROM benchmark)
SELECT i.source, i.id, coalesce(array_to_string(t.concepts, ','), '') AS concepts FROM items i
LEFT JOIN (SELECT d.source, g.* FROM doc_tags g JOIN docs d USING (id) WHERE id IN (SELECT doc_id FROM labels)) t
  ON t.id = i.id AND t.source = i.source"""
    sql["recommend_history"] = _history_topk("users")
    sql["user_level"] = f"WITH {LABELLED}, {CATALOG_LEVEL}, {HISTORY}, {USER_LEVEL} SELECT * FROM user_levels"
    sql["recommend_user_level"] = _history_topk("user_levels")
    sql["knn_label"] = f"""WITH {LABELLED}, {TRAIN3}, {SPLIT}, known AS (SELECT * FROM split WHERE NOT is_test),
asked AS (SELECT * FROM split WHERE is_test),
{_corpus('known')}, {_word_table('q_words', 'asked')}, {_terms('q_terms', 'q_words')}, {_weights('q_w', 'q_terms', 'vocab')},
dots AS (SELECT q.id AS query, d.id, sum(q.w * d.w) AS dot FROM q_w q JOIN doc_w d USING (term) GROUP BY ALL),
near AS (SELECT a.id AS query, k.id, k.label, 1 - round(coalesce(dot, 0), 6) AS distance,
    row_number() OVER (PARTITION BY a.id ORDER BY round(coalesce(dot, 0), 6) DESC, k.id) AS rank
  FROM asked a CROSS JOIN known k LEFT JOIN dots x ON x.query = a.id AND x.id = k.id QUALIFY rank <= 9),
s AS (SELECT n.*, g.k, w.weights FROM near n, (SELECT unnest([3, 5, 7, 9]) AS k) g, (SELECT unnest(['uniform', 'distance']) AS weights) w
  WHERE n.rank <= g.k),
e AS (SELECT *, max(CASE WHEN distance <= 0 THEN 1 ELSE 0 END) OVER (PARTITION BY query, k, weights) AS exact FROM s),
v AS (SELECT query, k, weights, label, round(sum(CASE WHEN weights = 'uniform' THEN 1.0::DOUBLE
    WHEN exact = 1 THEN CASE WHEN distance <= 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE 1.0::DOUBLE / distance END), 6) AS votes
  FROM e GROUP BY ALL)
SELECT query, k, weights, label AS pred FROM (SELECT *, row_number() OVER (PARTITION BY query, k, weights ORDER BY votes DESC, label) AS rn FROM v) WHERE rn = 1"""

    sql["class_weights"] = f"""WITH {LABELLED}, {TRAIN5}, c AS (SELECT label, count(*) AS n FROM train GROUP BY 1)
SELECT label, n, round(sum(n) OVER ()::DOUBLE / (count(*) OVER () * n), 6) AS weight FROM c"""
    sql["stratified_folds"] = f"WITH {LABELLED}, {TRAIN5}, {FOLDS} SELECT id, label, fold FROM folded"
    sql["train_test_split"] = f"WITH {LABELLED}, {TRAIN5}, {SPLIT} SELECT id, label, is_test FROM split"
    sql["seeded_sample"] = f"WITH {DOCS} SELECT id, source FROM docs ORDER BY {_vote_order()} LIMIT 40"
    sql["majority_by_fold"] = f"""WITH {LABELLED}, {TRAIN5}, {FOLDS},
o AS (SELECT f.fold, t.label AS pred, count(*) FILTER (t.fold <> f.fold) AS n
  FROM (SELECT DISTINCT fold FROM folded) f CROSS JOIN folded t GROUP BY ALL)
SELECT fold, pred FROM (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY n DESC, pred) AS rn FROM o) WHERE rn = 1"""
    cells = f"""WITH {PREDICTIONS}, present AS (SELECT DISTINCT model, label FROM predictions),
cells AS (SELECT a.model, a.label AS truth, b.label AS pred FROM present a JOIN present b USING (model)),
matrix AS (SELECT c.model, c.truth, c.pred, count(p.id) AS n FROM cells c LEFT JOIN predictions p
  ON p.model = c.model AND p.label = c.truth AND p.pred = c.pred GROUP BY ALL)"""
    sql["confusion_matrix"] = f"{cells} SELECT * FROM matrix"
    sql["confusion_wide"] = f"{cells} SELECT model, truth, " + ", ".join(
        f"max(n) FILTER (pred = '{name}') AS {name}" for name in LEVELS_3
    ) + " FROM matrix GROUP BY ALL"
    row = "round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1"
    total = "CAST(sum(support) AS BIGINT) AS support FROM classes GROUP BY model"
    accuracy = "sum(hit)::DOUBLE / sum(support)"
    sql["class_report"] = f"""WITH {PREDICTIONS}, {_per_class('model')}
SELECT model, label, {row.format(p='precision', r='recall', f='f1')}, CAST(support AS BIGINT) AS support FROM classes
UNION ALL SELECT model, 'accuracy', {row.format(p=accuracy, r=accuracy, f=accuracy)}, {total}
UNION ALL SELECT model, 'macro avg', {row.format(p='avg(precision)', r='avg(recall)', f='avg(f1)')}, {total}
UNION ALL SELECT model, 'weighted avg', {row.format(
        p='sum(precision * support)::DOUBLE / sum(support)', r='sum(recall * support)::DOUBLE / sum(support)',
        f='sum(f1 * support)::DOUBLE / sum(support)')}, {total}"""
    sql["fold_mean_std"] = f"""WITH {PREDICTIONS}, {_per_class('model, fold')}
SELECT model, round(avg(accuracy), 6) AS accuracy, round(stddev_pop(accuracy), 6) AS accuracy_std,
  round(avg(f1_macro), 6) AS f1_macro, round(stddev_pop(f1_macro), 6) AS f1_macro_std,
  round(avg(f1_weighted), 6) AS f1_weighted FROM measures GROUP BY model"""
    sql["leaderboard"] = f"WITH {SOURCE_METRICS} SELECT * FROM placed"
    sql["best_by_source"] = f"WITH {SOURCE_METRICS} SELECT * EXCLUDE (place) FROM placed WHERE place = 1"
    sql["f1_grid"] = f"WITH {SOURCE_METRICS} SELECT model, " + ", ".join(
        f"max(f1_macro) FILTER (source || '_' || n_levels = '{s}') AS {s}" for s in SETTINGS
    ) + " FROM board GROUP BY model"

    doc_tags = f"WITH {DOCS}, {_word_table('doc_words', 'docs')}, {tags}"
    sql["concept_tags"] = f"""{doc_tags} SELECT d.id, coalesce(array_to_string(t.concepts, ','), '') AS concepts
FROM docs d LEFT JOIN doc_tags t USING (id)"""
    sql["concept_frequency"] = f"""{doc_tags} SELECT concept, count(*) AS n FROM
(SELECT unnest(concepts) AS concept FROM doc_tags) GROUP BY 1"""
    sql["concept_onehot"] = f"{doc_tags} SELECT d.id, " + ", ".join(
        f"CASE WHEN d.id % 4 <> 0 AND coalesce(list_contains(t.concepts, '{c}'), false) THEN 1 ELSE 0 END AS {c}"
        for c in CONCEPTS
    ) + " FROM docs d LEFT JOIN doc_tags t USING (id)"
    second = ["arvores", "forca_bruta", "busca_binaria", None, None]
    second_case = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(second) if v)
    sql["concept_roundtrip"] = f"""SELECT event_id, array_to_string(list_sort(list_distinct(list_filter(
  [({_list(CONCEPTS)})[1 + event_id % 15], CASE user_id % 5 {second_case} END], lambda c: c IS NOT NULL))), ',') AS concepts FROM events"""
    shots = f"""shots AS (SELECT id, text, label, CAST(row_number() OVER (PARTITION BY label ORDER BY {_vote_order()}) AS INTEGER) AS rank FROM train)"""
    sql["few_shot_sample"] = f"""WITH {LABELLED}, {TRAIN5}, {shots}
SELECT id, label, rank, text AS example FROM shots WHERE rank <= 2"""
    sql["few_shot_label"] = f"""WITH {LABELLED}, {TRAIN5}, {shots}, {_corpus()},
ex AS (SELECT id, label FROM shots WHERE rank = 1),
dots AS (SELECT d.id, e.id AS ex, sum(d.w * e.w) AS dot FROM doc_w d JOIN doc_w e USING (term) JOIN ex ON ex.id = e.id GROUP BY ALL)
SELECT id, pred, cosine FROM (SELECT d.id, ex.label AS pred, round(coalesce(dot, 0), 6) AS cosine,
  row_number() OVER (PARTITION BY d.id ORDER BY round(coalesce(dot, 0), 6) DESC, ex.id) AS rn
  FROM docs d CROSS JOIN ex LEFT JOIN dots ON dots.id = d.id AND dots.ex = ex.id) WHERE rn = 1"""
    sql["pack_requests"] = f"""WITH {DOCS}, r AS (SELECT id, text AS t, row_number() OVER (ORDER BY id) AS rn FROM docs)
SELECT (rn - 1) // 10 AS pack, count(*) AS n, min(id) AS first_id, max(id) AS last_id,
  md5(string_agg('Item ' || ((rn - 1) % 10 + 1) || ':' || chr(10) || t, chr(10) || chr(10) ORDER BY rn)) AS body_md5 FROM r GROUP BY 1"""
    fits = "w.n < 10 AND w.used + r.size <= 20000"
    sql["pack_requests_by_size"] = f"""WITH RECURSIVE r AS (SELECT doc_id AS id, coalesce(text, '') AS t,
    length(coalesce(text, '')) AS size, row_number() OVER (ORDER BY doc_id) AS rn FROM documents),
walk AS (SELECT rn, CAST(0 AS BIGINT) AS pack, CAST(1 AS BIGINT) AS n, CAST(size AS BIGINT) AS used FROM r WHERE rn = 1
  UNION ALL SELECT r.rn, CASE WHEN {fits} THEN w.pack ELSE w.pack + 1 END, CASE WHEN {fits} THEN w.n + 1 ELSE 1 END,
    CASE WHEN {fits} THEN w.used + r.size ELSE r.size END FROM walk w JOIN r ON r.rn = w.rn + 1)
SELECT pack, count(*) AS n, min(id) AS first_id, max(id) AS last_id, CAST(sum(size) AS BIGINT) AS n_chars,
  md5(string_agg('Item ' || n || ':' || chr(10) || t, chr(10) || chr(10) ORDER BY rn)) AS body_md5
FROM walk JOIN r USING (rn) GROUP BY pack"""
    sql["json_array_records"] = "SELECT doc_id AS id, md5(text) AS text_md5, lang FROM documents"
    sql["csv_records"] = "SELECT doc_id AS id, source, md5(text) AS text_md5 FROM documents"
    head = _prompt_head().replace("'", "''")
    sql["request_prompts"] = f"""WITH p AS (SELECT doc_id AS id, '{head}' || text AS body FROM documents)
SELECT id, CAST(length(body) AS INTEGER) AS n_chars, md5(body) AS body_md5 FROM p"""
    sql["parse_replies"] = """SELECT event_id AS id, CASE WHEN event_id % 5 < 4 THEN event_id END AS reply_id,
  CASE WHEN event_id % 5 < 4 THEN event_type END AS dificuldade FROM events"""
    sql["match_replies"] = """WITH r AS (SELECT event_id // 10 AS pack, event_id % 10 + 1 AS position FROM events),
a AS (SELECT *, CASE WHEN position % 3 = 0 THEN NULL WHEN position % 5 = 0 THEN 'again'
  WHEN (pack + position) % 7 = 0 THEN '' ELSE 'v' || position END AS answer FROM r)
SELECT pack, position, answer, coalesce(answer, '') = '' AS retry FROM a"""
    sql["pending_items"] = "SELECT doc_id AS id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
    sql["cached_predictions"] = f"WITH {LABEL_CACHE} SELECT * FROM aligned"
    # Benchmark items have ids that documents have too; only documents are cached.
    sql["pending_by_source"] = """SELECT doc_id AS id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT item_id, 'benchmark' FROM benchmark"""
    sql["cached_by_source"] = f"""WITH {LABEL_CACHE} SELECT * FROM aligned
UNION ALL SELECT item_id, 'benchmark', NULL FROM benchmark"""
    sql["resume_labels"] = f"""WITH {LABEL_CACHE}, every AS (SELECT * FROM aligned
  UNION ALL SELECT item_id, 'benchmark', NULL FROM benchmark)
SELECT id, source, coalesce(pred, CASE WHEN id % 2 = 0 THEN 'facil' ELSE 'muito_dificil' END) AS pred FROM every"""
    sql["cache_coverage"] = f"""WITH {LABEL_CACHE} SELECT count(*) AS total, count(pred) AS covered,
  count(*) - count(pred) AS missing FROM aligned"""
    return sql


@lru_cache(maxsize=1)
def oracles() -> dict[str, str]:
    """Built when asked for: queries never depend on it."""
    return _oracles()
