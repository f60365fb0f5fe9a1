"""Record identity, index, model and vocabulary queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weblode.catalog.registry import query, table
from weblode.config import DecisionModel
from weblode.functions import text as X
from weblode.operators import index, model, records, vocabulary
from weblode.session import work_path

PAIR = ["l_partkey", "l_suppkey"]


@query(
    "d1_not_indexed",
    """
    WITH indexed AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM indexed i WHERE i.l_partkey = l.l_partkey AND i.l_suppkey = l.l_suppkey)
    """,
)
def not_indexed(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    indexed = lines.where(F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    crawled = lines.select("l_orderkey", "l_linenumber", *PAIR)
    return records.not_indexed(crawled, indexed.select(*PAIR), PAIR)


@query(
    "d2_incomplete",
    """
    SELECT c_custkey, segment FROM (
      SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'N/A' WHEN c_nationkey > 3 THEN c_mktsegment END AS segment FROM customer)
    WHERE segment <> 'N/A'
    """,
)
def incomplete(spark, sf_dir):
    segment = F.when(F.col("c_acctbal") < 0, "N/A").when(F.col("c_nationkey") > 3, F.col("c_mktsegment"))
    found = table(spark, sf_dir, "customer").select("c_custkey", segment.alias("segment"))
    return records.complete(found, ["c_custkey", "segment"])


@query(
    "d3_first_arrival",
    """
    SELECT event_id, user_id, event_type, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1
    """,
)
def first_arrival(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return records.first_of_each(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "d4_upsert",
    """
    WITH latest AS (SELECT o_custkey AS id, o_orderpriority AS name, o_totalprice AS amount FROM orders
                    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
    SELECT id, name, amount FROM latest
    UNION ALL
    SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT id FROM latest)
    """,
)
def upsert(spark, sf_dir):
    path = work_path(spark, "index")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("amount"),
        "o_orderkey",
    )
    index.upsert(path, customers, "id", buckets=16)
    latest = records.last_of_each(orders, "id", ["o_orderkey"]).drop("o_orderkey")
    index.upsert(path, latest, "id", buckets=16)
    return index.read_index(spark, path)


@query(
    "d6_tolerant_typing",
    """
    SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS priority,
           TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS DATE) AS day,
           TRY_CAST(CASE WHEN o_orderstatus = 'O' THEN CAST(o_custkey AS VARCHAR) ELSE o_orderstatus || o_custkey END AS BIGINT) AS customer
    FROM orders
    """,
)
def tolerant_typing(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_orderpriority").alias("priority"),
        F.when(F.col("o_orderstatus") == "F", "n/a").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_custkey").cast("string"))
        .otherwise(F.concat("o_orderstatus", "o_custkey"))
        .alias("customer"),
    )
    return index.tolerant(orders, {"priority": "int", "day": "date", "customer": "bigint"})


@query(
    "d7_presence",
    "SELECT c_custkey, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AS present FROM customer",
)
def presence(spark, sf_dir):
    closed = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return records.presence(
        table(spark, sf_dir, "customer").select("c_custkey"),
        closed.select(F.col("o_custkey").alias("c_custkey")),
        ["c_custkey"],
    )


@query(
    "m1_typed_projection",
    """
    SELECT o_orderkey AS url, TRY_CAST(o_orderpriority AS INTEGER) AS as_integer, CAST(o_custkey AS BIGINT) AS as_long,
           CAST(o_totalprice AS DOUBLE) AS as_double, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS as_date, o_orderstatus AS as_text
    FROM orders
    """,
)
def typed_projection(spark, sf_dir):
    saved = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("url"),
        F.col("o_orderpriority").alias("as_integer"),
        F.col("o_custkey").cast("string").alias("as_long"),
        F.col("o_totalprice").cast("string").alias("as_double"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("as_date"),
        F.col("o_orderstatus").alias("as_text"),
    )
    kinds = ("integer", "long", "double", "date", "text")
    wanted = {
        f"as_{k}": {"scoreCalculation": {"datatype": "text"}, "schemaMapping": {"schemaDataType": k}} for k in kinds
    }
    return model.to_model(saved, DecisionModel.parse("orders", wanted))


@query(
    "m2_default",
    """
    SELECT c_custkey, coalesce(nullif(CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE c_mktsegment END, 'N/A'), 'none') AS segment
    FROM customer
    """,
)
def default(spark, sf_dir):
    segment = F.when(F.col("c_acctbal") < 0, "N/A").otherwise(F.col("c_mktsegment"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey", model.or_default(model.present(segment), "none").alias("segment")
    )


LOOKUP = {"ring": "R", "small": "S", "blue": "B", "bolt": "T"}


def sql_enumeration(text: str, default: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({text}, '{k}') THEN '{v}'" for k, v in LOOKUP.items()) + f" ELSE {default} END"


def sql_canonical(text: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({text}, '{k}') THEN '{k}'" for k in LOOKUP) + f" ELSE {text} END"


@query(
    "m3_enumeration",
    f"SELECT p_partkey, {sql_enumeration('p_name', chr(39) + 'other' + chr(39))} AS code, {sql_canonical('p_name')} AS canonical FROM part",
)
def enumeration(spark, sf_dir):
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        model.enumeration(name, LOOKUP, "other").alias("code"),
        F.coalesce(model.canonical_key(name, LOOKUP), name).alias("canonical"),
    )


SQL_DIGITS = "coalesce(nullif(regexp_replace({0}, '[^0-9]', '', 'g'), ''), '0')"


@query(
    "m4_digits_only",
    f"SELECT doc_id, {SQL_DIGITS.format('text')} AS digits FROM documents",
)
def digits_only(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.digits_only(F.col("text")).alias("digits"))


@query(
    "m5_numbers",
    f"""
    SELECT o_orderkey, TRY_CAST({SQL_DIGITS.format('text')} AS BIGINT) AS whole, TRY_CAST({SQL_DIGITS.format('text')} AS DOUBLE) AS amount
    FROM (SELECT o_orderkey, '-USD ' || format('{{:,.2f}}', o_totalprice) AS text FROM orders)
    """,
)
def numbers(spark, sf_dir):
    text = F.concat(F.lit("-USD "), F.format_number("o_totalprice", 2))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", model.whole_number(text).alias("whole"), model.amount(text).alias("amount")
    )


@query("m6_pass_through", "SELECT doc_id AS url, lang, source FROM documents")
def pass_through(spark, sf_dir):
    wanted = {
        k: {"scoreCalculation": {"datatype": "text"}, "schemaMapping": {"schemaDataType": "keyword"}}
        for k in ("lang", "source")
    }
    saved = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("url"), "lang", "source")
    return model.to_model(saved, DecisionModel.parse("documents", wanted))


@query(
    "m7_value_list",
    """
    SELECT p_partkey, CASE WHEN p_size > 40 THEN '' WHEN p_size > 20 THEN p_name WHEN p_size > 10 THEN p_name || '|' || p_brand
                           ELSE p_name || '|' || p_brand || '|' || p_type END AS listed
    FROM part
    """,
)
def value_list(spark, sf_dir):
    size = F.col("p_size")
    held = [
        model.present(F.when(size > 40, "N/A").otherwise(F.col("p_name"))),
        model.present(F.when(size > 20, "N/A").otherwise(F.col("p_brand"))),
        model.present(F.when((size > 10) & (size <= 20), "N/A").otherwise(F.col("p_type"))),
    ]
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(model.value_list(held), "|").alias("listed"))


RULES = [
    {"op": "gte", "field": "balance", "value": 5000, "trueBody": "rich", "falseBody": "modest"},
    {"op": "lte", "field": "balance", "value": 1, "trueBody": "x", "falseBody": "y"},
    {"op": "gte", "field": "nation", "value": 10, "trueBody": "east", "falseBody": "west"},
]


@query(
    "m8_comparison",
    """
    SELECT c_custkey, trim(concat_ws(' ', CASE WHEN c_acctbal >= 0 THEN CASE WHEN trunc(c_acctbal) >= 5000 THEN 'rich' ELSE 'modest' END END,
                                     CASE WHEN c_nationkey >= 10 THEN 'east' ELSE 'west' END)) AS verdict
    FROM customer
    """,
)
def comparison(spark, sf_dir):
    fields = {
        "balance": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
        "nation": F.col("c_nationkey").cast("string"),
    }
    return table(spark, sf_dir, "customer").select(
        "c_custkey", model.comparison(RULES, fields.__getitem__).alias("verdict")
    )


@query("c1_gazetteer_names", "SELECT DISTINCT p_name AS value FROM part ORDER BY value")
def gazetteer_names(spark, sf_dir):
    return vocabulary.gazetteer_names(table(spark, sf_dir, "part"), "p_name")


def sql_camel(text: str) -> str:
    """Separators put in by two consuming patterns, each run twice because matches may not overlap."""
    out = text
    for pattern in (r"([^\p{Lu}\x01])(\p{Lu})", r"(\p{Lu})(\p{Lu}[^\p{Lu}\x01])"):
        for _ in range(2):
            out = rf"regexp_replace({out}, '{pattern}', '\1' || chr(1) || '\2', 'g')"
    return f"list_filter(string_split({out}, chr(1)), lambda p: p <> '')"


@query("c2_camel_pieces", f"SELECT doc_id, array_to_string({sql_camel('text')}, '|') AS pieces FROM documents")
def camel_pieces(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(X.camel_pieces(F.col("text")), "|").alias("pieces")
    )


DELIMITERS = [",", ". ", "\n"]


def sql_pieces(text: str) -> str:
    parts = [f"string_split({text}, ',')", f"string_split({text}, '. ')", f"string_split({text}, chr(10))"]
    return f"list_concat(list_concat({parts[0]}, {parts[1]}), {parts[2]})"


@query("c3_delimiter_pieces", f"SELECT doc_id, unnest({sql_pieces('text')}) AS piece FROM documents")
def delimiter_pieces(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.explode(X.delimiter_pieces(F.col("text"), DELIMITERS)).alias("piece")
    )


SQL_LETTERS = "trim(regexp_replace({0}, '[^A-Za-z ]+', '', 'g'), ' ')"


@query("c4_letters_only", f"SELECT doc_id, {SQL_LETTERS.format('text')} AS text FROM documents")
def letters_only(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.letters_only(F.col("text")).alias("text"))


def sql_repair_ctes(source: str, column: str) -> str:
    """One step per ending: ``repaired`` holds the final text in ``v``."""
    steps, last = [], f"(SELECT *, {column} AS v FROM {source})"
    for i, e in enumerate(X.DANGLING_ENDINGS):
        steps.append(
            f"repair{i} AS (SELECT * REPLACE (CASE WHEN ends_with(v, '{e}') THEN replace(v, '{e}', '') ELSE v END AS v) FROM {last})"
        )
        last = f"repair{i}"
    return ", ".join(steps) + f", repaired AS MATERIALIZED (SELECT * FROM {last})"


@query(
    "c5_repair_ending",
    "WITH pieces AS (SELECT doc_id, unnest(string_split(text, ',')) AS piece FROM documents), "
    + sql_repair_ctes("pieces", "piece")
    + " SELECT doc_id, piece, v AS repaired FROM repaired",
)
def repair_ending(spark, sf_dir):
    pieces = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", ",")).alias("piece"))
    return pieces.select("doc_id", "piece", X.repair_ending(F.col("piece")).alias("repaired"))


SQL_CANDIDATE = r"length({0}) > 1 AND NOT regexp_matches({0}, '^(\p{{Lu}}+|\p{{Ll}}+)$')"


@query(
    "c6_candidates",
    "WITH pieces AS (SELECT doc_id, unnest(string_split(text, ' ')) AS piece FROM documents) SELECT doc_id, piece FROM pieces WHERE "
    + SQL_CANDIDATE.format("piece"),
)
def candidates(spark, sf_dir):
    pieces = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("piece"))
    return pieces.where(X.is_candidate(F.col("piece")))


FORBIDDEN = ("The", "Of the", "Et")

SQL_VOCABULARY = (
    f"WITH camel AS (SELECT DISTINCT unnest({sql_camel('text')}) AS piece FROM documents), "
    f"parts AS (SELECT DISTINCT unnest({sql_pieces('piece')}) AS piece FROM camel), "
    f"letters AS (SELECT DISTINCT {SQL_LETTERS.format('piece')} AS piece FROM parts), "
    + sql_repair_ctes("letters", "piece")
    + " SELECT DISTINCT v AS value FROM repaired WHERE "
    + SQL_CANDIDATE.format("v")
    + " AND v NOT IN ('The', 'Of the', 'Et')"
)


@query("c7_vocabulary", SQL_VOCABULARY)
def vocabulary_of_documents(spark, sf_dir):
    return vocabulary.vocabulary(table(spark, sf_dir, "documents"), "text", DELIMITERS, FORBIDDEN)
