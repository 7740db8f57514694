"""The registered queries of this package, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fill_middle, line_dedup, main_text, mixing, near_dup, ngram_join, packing, quality, repeats, role_repair, top_k
from . import toxicity, url_rules
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over ``documents``; trusted documents are those ``labels`` marks as good."""
    documents = table(spark, sf_dir, "documents")
    ratio = quality.fit(documents, table(spark, sf_dir, "labels").where("quality = 1"))
    return quality.score(documents, ratio)


TOXIC_FROM = 0.7  # score from which a document counts as toxic


def held_out():
    """Whether a row's labels are kept for evaluation."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    """A model fitted on the labels that are not held out."""
    return toxicity.fit(documents, labels.where(~held_out()))


def toxicity_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of ``documents`` by a model fitted on the labels that are not held out."""
    return toxicity.score(documents, toxicity_model(documents, labels))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
        "evidence",
        F.size("passages").alias("n_passages"),
    )


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), k=4)


TOKENIZER = "word_bpe_49k.json"


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenized(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packing.pack(pieces)


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = main_text.extract(pages, main_text.fit(pages))
    return found.withColumn("n_chars", F.length("text").cast("long"))


#: Token shares the mixture is to have, and the topics a text counts under (the first that fits).
MIX = mixing.Targets(
    languages={"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.12, mixing.REST: 0.01},
    topics={"legal": 0.08, "contact": 0.06, "table": 0.04, "noise": 0.04, "prose": 0.78},
    source_power=0.8,
    keep=0.9,
)
TOPIC_SQL = """CASE WHEN strpos(lower(text), 'licens') > 0 OR strpos(lower(text), 'rights reserved') > 0 THEN 'legal'
     WHEN strpos(text, '@') > 0 THEN 'contact' WHEN strpos(text, ' | ') > 0 THEN 'table'
     WHEN strpos(text, '***') > 0 OR strpos(text, '!!') > 0 THEN 'noise' ELSE 'prose' END"""


def topic():
    return F.expr(TOPIC_SQL.replace("strpos", "instr"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_weights(table(spark, sf_dir, "documents"), topic(), MIX)
    return mixed.select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "n_tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        "sampled",
    )


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        F.expr("aggregate(spans, 0L, (t, s) -> t + s.hi - s.lo)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("rest", 256).alias("kept_sha256"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring lines: doc_id, lines dropped, and length and digest of what is left."""
    kept = line_dedup.drop_lines(table(spark, sf_dir, "documents"), words=1)
    left = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_dropped", F.length(left).cast("long").alias("n_left"), F.sha2(left, 256).alias("left_sha256"))


#: Curated rules (verdict, host and path); a rule holds for the host and its subdomains.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The digest of every transformed text, and of the text rebuilt from it."""
    made = fill_middle.fill_middle(table(spark, sf_dir, "documents"), seed=42)
    text = fill_middle.restored(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(text, 256).alias("restored_sha256"),
    )


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with planted faults, by the hash of ``conv_id:turn``; a dropped turn stays as a row that is not ``there``."""
    blank = F.lit(" ")
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    code, role, text = F.crc32(key) % 20, F.coalesce("role", blank), F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (code != 0).alias("there"),
        F.when(code == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("copies"),
    )
    return rows.withColumn("copy", F.explode("copies")).drop("copies", "copy")


def op13_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return role_repair.repair(damaged(table(spark, sf_dir, "conversations")), F.col("there"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_toxicity": op2_toxicity,
    "op3_near_dup": op3_near_dup,
    "op4_packing": op4_packing,
    "op5_top_k": op5_top_k,
    "op6_main_text": op6_main_text,
    "op7_mixing": op7_mixing,
    "op8_repeats": op8_repeats,
    "op9_line_dedup": op9_line_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_fill_middle": op11_fill_middle,
    "op12_ngram_join": op12_ngram_join,
    "op13_role_repair": op13_role_repair,
}
#: Exact integer products of whole vectors.
TOP_K_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
p AS (SELECT q.vec_id query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT rank, vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

SQL: dict[str, str] = {
    "op5_top_k": TOP_K_SQL,
    "op7_mixing": mixing.oracle(TOPIC_SQL, MIX),
    "op11_fill_middle": fill_middle.oracle(42),
}
