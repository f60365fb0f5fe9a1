"""The registered queries of this package and the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weblode.llm import alignment, bpe, chat, content_sort, decontaminate, host_graph, lm, negatives, quality, shards, simhash, suffixes, token_counts
from weblode.llm.common import text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_byte_network")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    network = quality.trained(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, network).select("doc_id", quality.held_out().alias("held_out"), "score", "predicted")


@query("op2_shuffled_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.shuffled_shards(table(spark, sf_dir, "documents"), shards=8, stable=True)
    text = text_of("text")
    return placed.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    "op3_content_sort",
    r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm, length(coalesce(text, '')) AS points
  FROM documents
), r AS (
  SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
    row_number() OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS place
  FROM n
)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r
""",
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = content_sort.exact_duplicates(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query(
    "op4_decontamination",
    r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), iw AS (
  SELECT item, least(len(w), 10) AS n, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS pos FROM i WHERE len(w) > 0
), win AS (SELECT DISTINCT item, n, array_to_string(w[pos:pos + n - 1], ' ') AS s FROM iw
), sizes AS (SELECT DISTINCT n FROM win
), dw AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS pos FROM d, sizes WHERE len(w) >= n
), hit AS (
  SELECT doc_id, pos, dw.n, item FROM dw JOIN win ON win.n = dw.n AND win.s = array_to_string(dw.w[pos:pos + dw.n - 1], ' ')
), words AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + n)) AS word FROM hit
), items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hit GROUP BY doc_id
), hits AS (SELECT doc_id, count(*) AS n_hit FROM words GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN items USING (doc_id) LEFT JOIN hits USING (doc_id)
""",
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary; a parameter of the operators, named here for the queries."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op5_speculative_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encoded(docs, tokenizer_path()))


@query("op6_kneser_ney")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.scored(table(spark, sf_dir, "documents"))
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op7_host_graph", host_graph.oracle())
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_graph.judged_pages(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


# A question is a call of the tool that answered it; it needs the answer to the question before.
ANSWER_SCHEMA = {
    "type": "object",
    "required": ["text", "turn"],
    "properties": {"text": {"type": "string", "minLength": 1}, "turn": {"type": "integer", "minimum": 0}},
    "additionalProperties": False,
}


@query("op8_tool_calls")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations")
    call_id = F.concat_ws("-", "conv_id", F.col("turn").cast("string"))
    asked = turns.where("role = 'user'")
    calls = asked.select(
        "conv_id", "turn", F.lit(1).alias("position"), call_id.alias("call_id"), F.lit("answer").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        F.array(F.concat_ws("-", "conv_id", (F.col("turn") - 2).cast("string"))).alias("needs"),
    )
    answers = turns.where("role = 'assistant'")
    results = answers.select(F.concat_ws("-", "conv_id", (F.col("turn") - 1).cast("string")).alias("call_id"), "turn", F.col("text").alias("content"))
    messages = turns.where("role is null or role <> 'assistant'").select("conv_id", "turn", "role", F.col("text").alias("content"))
    return chat.chat_lines(messages, calls, results, {"answer": ANSWER_SCHEMA})


@query("op9_interval_expansion")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffixes.without_repeats(table(spark, sf_dir, "documents"), stable=True)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["stop"] - s["start"])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query("op10_simhash_pivots")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op11_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op12_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


@query(
    "op13_hard_negatives",
    """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, list_dot_product(a.e, r.e)::BIGINT AS score
  FROM v a JOIN v r ON a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id
), p AS (
  SELECT anchor_id, other_id, score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.other_id AS positive_id, s.other_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
  WHERE place <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""",
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0, "vec_id", "label", "embedding")
