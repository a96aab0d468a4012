"""One query for each operator on its whole table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gradus.llm import (
    bpe,
    chat,
    html_extraction,
    orchard,
    order_minhash,
    pii,
    sharding,
    superminhash,
    tile_join,
    tokenizer_pairs,
    toxicity,
    url_filter,
    wu_manber,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return superminhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=2)


URL_RULES = [
    url_filter.Rule("allow", "com"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


@_query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by the rules; else blocked where its canonical URL has several pages."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    form = url_filter.canonical(url_filter.host_of(F.col("url")), url_filter.path_of(F.col("url")))
    repeated = pages.groupBy(form.alias("listed")).count().where("listed <> '' AND count > 1")
    judged = url_filter.judge(pages, URL_RULES, repeated.select("listed"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _op2_sql() -> str:
    fits = [
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        for r in sorted(URL_RULES, key=lambda r: -len(r.name))
    ]
    ordered = sorted(URL_RULES, key=lambda r: -len(r.name))
    rule = " ".join(f"{f} THEN '{r.name}'" for f, r in zip(fits, ordered, strict=True))
    verdict = " ".join(f"{f} THEN '{r.verdict}'" for f, r in zip(fits, ordered, strict=True))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""WITH s AS (SELECT page_id,
  translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{upper.lower()}') AS host,
  regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
k AS (SELECT *, regexp_replace(host, '^www\\.', '') || regexp_replace(path, '/+$', '') AS form FROM s),
n AS (SELECT *, count(*) OVER (PARTITION BY form) AS times FROM k)
SELECT page_id, host, path, CASE {rule} END AS rule,
  CASE {verdict} WHEN form <> '' AND times > 1 THEN 'block' ELSE 'allow' END AS verdict FROM n"""


ORACLES["op2_url_filters"] = _op2_sql()


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), sharding.even_tree(16))


@_query
def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_pairs(_table(spark, sf_dir, "documents"))


def _chat_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations as an event log.

    Every row becomes a turn: a message with a draft (its text reversed), an edit that takes
    the draft back, and the text in two deltas. Each turn is settled before the next opens.
    """
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        control.alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = rows.union(extra).withColumn("turn", F.row_number().over(order).cast("long"))
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.floor(F.char_length(text) / 2).cast("int")
    events = [
        ("message", F.reverse(text)),
        ("edit", F.lit("")),
        ("delta", F.substr(text, F.lit(1), half)),
        ("delta", F.substr(text, half + 1)),
    ]
    made = F.array(
        *[
            F.struct(
                (F.col("turn") * len(events) + i).alias("seq"),
                F.lit(kind).alias("kind"),
                body.alias("text"),
            )
            for i, (kind, body) in enumerate(events)
        ]
    )
    log = turns.select("conv_id", "turn", "role", F.explode(made).alias("e"))
    return log.select("conv_id", "e.seq", "turn", "e.kind", "role", "e.text")


@_query
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = chat.render(chat.fold_events(_chat_log(spark, sf_dir)))
    back = made.select("conv_id", "formatted", "loss_spans", F.explode(F.array(chat.parse(F.col("formatted")))).alias("turns"))
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    loss = back.withColumn(
        "loss", F.explode(F.array(chat.trained_text(F.col("formatted"), F.col("loss_spans"))))
    )
    return loss.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(told, "UTF-8"), 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss", "UTF-8"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLES["op8_chat_formatting"] = r"""WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (SELECT *, length(replace(replace(role, '\', '\\'), '<|', '<\|'))
  + length(role) - length(replace(role, chr(10), ''))
  + length(replace(replace(text, '\', '\\'), '<|', '<\|'))
  + length('<|turn|>' || chr(10) || '<|end|>' || chr(10)) AS size FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


@_query
def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = wu_manber.decontaminate(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(F.array_sort("items"), ","), "UTF-8"), 256).alias("items_sha256"),
        "contaminated",
    )


ORACLES["op9_benchmark_decontamination"] = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
  SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw))),
hits AS (SELECT dw.r, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
item AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN item USING (r)"""


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


@_query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs)

    def told(column: str):
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
            ",",
        )

    counts = [
        F.size(F.filter("base_spans", _of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in pii.KINDS
    ]
    digest = F.sha2(F.encode(told("base_spans"), "UTF-8"), 256)
    return found.select("doc_id", *counts, digest.alias("base_sha256"), told("spans").alias("spans"))

TOKENIZER = "byte_bpe_multi_50k.tiktoken"


@_query
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    made = bpe.digests(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)
    return made.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query
def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract(pages).select("page_id", "url", "text", "n_chars")


@_query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.predict(docs, chain).drop("text")


A_TOKENIZER, B_TOKENIZER = "byte_bpe_50k.json", "piece_bpe_32k.model"


@_query
def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenizer_pairs.align(docs, public_tokenizers.path(A_TOKENIZER), public_tokenizers.path(B_TOKENIZER))


@_query
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(_table(spark, sf_dir, "embeddings"))


def _op12_sql(k: int = 8, rounds: int = 10) -> str:
    """Every round as two steps: each vector's nearest centroid, then the new centroids."""
    steps = [
        """kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
  list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v AS m FROM (
  SELECT sha256('3:' || vec_id) AS h, v FROM kept) ORDER BY h NULLS LAST, v LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT r, min(s).c AS c, min(s).d AS d FROM (
  SELECT r, struct_pack(d := CAST(list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT),
    c := c) AS s FROM kept, c{i}) GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(n.m, c{i}.m) AS m FROM c{i} LEFT JOIN (
  SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM (
    SELECT c, i, sum(x) AS s, count(*) AS n FROM (
      SELECT c, unnest(v) AS x, unnest(range(64)) AS i FROM kept JOIN a{i} USING (r)) GROUP BY c, i) GROUP BY c) n
  ON n.c = c{i}.c)"""
            )
    return f"""WITH {', '.join(steps)}
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, a.d AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(f.m, ',')) AS centroid_sha256
FROM kept JOIN a{rounds} a USING (r) JOIN c{rounds} f ON f.c = a.c"""


ORACLES["op12_centroid_clustering"] = _op12_sql()


@_query
def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tile_join.join_alike(_table(spark, sf_dir, "documents"))
