"""Value typing queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weblode.catalog.page_queries import sql_normal
from weblode.catalog.registry import query, table
from weblode.functions import values
from weblode.operators.places import locate

# Python and Spark count these as white space; DuckDB's \s does not.
SPACE = r"[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


def sql_token(text: str) -> str:
    return (
        f"list_filter(list_transform(string_split_regex({text}, '{SPACE}'), "
        r"lambda t: regexp_replace(t, '[^\pN.,]+', '', 'g')), lambda t: t <> '')[1]"
    )


def price_texts(spark, sf_dir):
    text = F.concat(
        F.lit("total ("), "o_orderpriority", F.lit("): USD "), F.format_number("o_totalprice", 2), F.lit(" net.")
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))


SQL_PRICES = (
    "(SELECT o_orderkey, 'total (' || o_orderpriority || '): USD ' || format('{:,.2f}', o_totalprice) || ' net.' AS text FROM orders)"
)
AFTER_COLON = "regexp_replace(text, '^[^:]*:', '')"


@query("v1_numeric_token", f"SELECT o_orderkey, {sql_token('text')} AS token FROM {SQL_PRICES}")
def numeric_token(spark, sf_dir):
    return price_texts(spark, sf_dir).select("o_orderkey", values.numeric_token(F.col("text")).alias("token"))


@query("v1_numeric_token_documents", f"SELECT doc_id, {sql_token('text')} AS token FROM documents")
def numeric_token_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", values.numeric_token(F.col("text")).alias("token"))


@query("v2_normal_text", f"SELECT doc_id, {sql_normal('text')} AS text FROM documents")
def normal_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", values.normal_text(F.col("text")).alias("text"))


def sql_date(text: str) -> str:
    cases = "".join(
        f" WHEN regexp_matches({text}, '{p}') THEN regexp_replace({text}, '(?s)^.*?{p}.*$', '{g.replace('$', chr(92))}')"
        for p, g in values.DATE_PATTERNS
    )
    return f"CASE{cases} END"


DATE_FORMATS = ("d-M-yyyy", "d/M/yyyy", "yyyy-M-d", "yyyy\\M\\d", "yyyy-M", "M-yyyy", "'year' yyyy")
SQL_FORMATS = ("%-d-%-m-%Y", "%-d/%-m/%Y", "%Y-%-m-%-d", "%Y\\%-m\\%-d", "%Y-%-m", "%-m-%Y", "year %Y")


@query(
    "v3_date",
    "SELECT o_orderkey, "
    + sql_date("text")
    + " AS date_text FROM (SELECT o_orderkey, 'on ' || CASE o_orderkey % 7 "
    + "".join(f"WHEN {i} THEN strftime(o_orderdate, '{f}') " for i, f in enumerate(SQL_FORMATS))
    + "END || ' placed' AS text FROM orders)",
)
def date_text(spark, sf_dir):
    form = F.element_at(
        F.array(*[F.date_format("o_orderdate", f) for f in DATE_FORMATS]), (F.col("o_orderkey") % 7 + 1).cast("int")
    )
    dated = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("on "), form, F.lit(" placed")).alias("text")
    )
    return dated.select("o_orderkey", values.date_text(F.col("text")).alias("date_text"))


@query("v3_date_documents", f"SELECT doc_id, {sql_date('text')} AS date_text FROM documents")
def date_documents(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", values.date_text(F.col("text")).alias("date_text"))


SQL_ORIGINS = """
t AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN c_name || ' of ' || n_name || ' (' || c_mktsegment || ')'
                                           WHEN 1 THEN 'N' || n_nationkey ELSE c_mktsegment END AS text
      FROM customer JOIN nation ON n_nationkey = c_nationkey)"""


@query(
    "v4_country",
    f"""
    WITH {SQL_ORIGINS},
    named AS (SELECT c_custkey, min_by(n_name, n_nationkey) AS name FROM t JOIN nation ON contains(text, n_name) GROUP BY c_custkey)
    SELECT t.c_custkey, coalesce(named.name, coded.n_name, text) AS country
    FROM t LEFT JOIN named USING (c_custkey) LEFT JOIN nation coded ON 'N' || coded.n_nationkey = text
    """,
)
def country(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    # The country table is a plan input: the 25 nations, as (name, code).
    pairs = [(r["n_name"], f"N{r['n_nationkey']}") for r in nation.orderBy("n_nationkey").collect()]
    text = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat("c_name", F.lit(" of "), "n_name", F.lit(" ("), "c_mktsegment", F.lit(")")))
        .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("N"), "n_nationkey"))
        .otherwise(F.col("c_mktsegment"))
    )
    joined = table(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", values.country(text, pairs).alias("country"))


CATEGORIES = {
    "bolt": "fastener",
    "nut|screw": "fastener",
    "ring": "seal",
    "widget": "gadget",
    "small": "little",
    "ECONOMY": "cheap",
    "red": "coloured",
    "blue": "coloured",
}


@query(
    "v5_category",
    "SELECT p_partkey, CASE "
    + " ".join(
        rf"WHEN regexp_matches(lower(text), '\b{k.lower()}\b') THEN '{v}'" for k, v in CATEGORIES.items()
    )
    + " ELSE 'Other Category' END AS category FROM (SELECT p_partkey, p_name || ' ' || p_type AS text FROM part)",
)
def category(spark, sf_dir):
    text = F.concat_ws(" ", "p_name", "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", values.category(text, CATEGORIES).alias("category"))


VOTES = {"th": "english", "ing": "english", "und": "german", "sch": "german", "que": "french", "eau": "french", "ción": "spanish", "the": "english"}


@query(
    "v6_category_votes",
    "WITH votes(ord, key, cat) AS (VALUES "
    + ", ".join(f"({i}, '{k}', '{v}')" for i, (k, v) in enumerate(VOTES.items()))
    + """),
    tally AS (SELECT doc_id, cat, count(*) AS n, min(ord) AS first FROM documents JOIN votes ON contains(lower(text), key) GROUP BY doc_id, cat),
    best AS (SELECT doc_id, cat FROM tally QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) = 1)
    SELECT doc_id, coalesce(cat, 'Other Category') AS category FROM documents LEFT JOIN best USING (doc_id)
    """,
)
def category_votes(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", values.category_by_votes(F.col("text"), VOTES).alias("category")
    )


@query(
    "v7_postcode",
    r"SELECT doc_id, nullif(regexp_extract(text, '\d{4} [A-Za-z]{2}'), '') AS postcode FROM documents",
)
def postcode(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", values.postcode(F.col("text")).alias("postcode"))


@query(
    "v8_location",
    """
    WITH cities AS (SELECT lower(trim(p_name)) AS k, min_by(p_name || ', ' || p_brand || ', ' || p_type, p_partkey) AS place
                    FROM part GROUP BY 1),
    texts AS (SELECT l_orderkey, l_linenumber,
                     CASE WHEN l_returnflag = 'R' THEN upper(p_name) WHEN l_returnflag = 'A' THEN 'nowhere ' || p_name END AS place_text
              FROM lineitem JOIN part ON p_partkey = l_partkey)
    SELECT l_orderkey, l_linenumber, place FROM texts LEFT JOIN cities ON k = lower(trim(place_text))
    """,
)
def location(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    cities = part.select(
        F.col("p_partkey").alias("geonameid"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("subcountry"),
        F.col("p_type").alias("country"),
    )
    shown = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("at ("), F.upper("p_name"), F.lit(")"))).when(
        F.col("l_returnflag") == "A", F.concat(F.lit("at (nowhere "), "p_name", F.lit(")"))
    )
    lines = table(spark, sf_dir, "lineitem").join(part, F.col("p_partkey") == F.col("l_partkey"))
    texts = lines.select(
        "l_orderkey", "l_linenumber", values.place_text(shown, [r"\((.*)\)"]).alias("place")
    )
    return locate(texts, "place", cities)


@query(
    "v9_integer",
    f"SELECT o_orderkey, TRY_CAST(replace(replace({sql_token(AFTER_COLON)}, ',', ''), '.', '') AS BIGINT) AS amount FROM {SQL_PRICES}",
)
def integer(spark, sf_dir):
    return price_texts(spark, sf_dir).select(
        "o_orderkey", values.integer(values.numeric_token(F.regexp_replace(F.col("text"), r"^[^:]*:", ""))).alias("amount")
    )


@query(
    "v10_decimal",
    f"SELECT o_orderkey, CAST(trunc(TRY_CAST(replace({sql_token(AFTER_COLON)}, ',', '') AS DOUBLE)) AS BIGINT) AS amount FROM {SQL_PRICES}",
)
def decimal(spark, sf_dir):
    return price_texts(spark, sf_dir).select(
        "o_orderkey", values.truncated_decimal(values.numeric_token(F.regexp_replace(F.col("text"), r"^[^:]*:", ""))).alias("amount")
    )


@query(
    "v11_removal",
    "SELECT p_partkey, replace(replace(p_name || ' ' || p_brand, 'blue ', ''), 'Brand#', '') AS text FROM part",
)
def removal(spark, sf_dir):
    text = F.concat_ws(" ", "p_name", "p_brand")
    return table(spark, sf_dir, "part").select(
        "p_partkey", values.remove_literals(text, ["blue ", "Brand#"]).alias("text")
    )


@query(
    "v12_innermost",
    r"""
    WITH RECURSIVE step AS (
      SELECT p_partkey, 0 AS n, repeat('a(', p_size) || p_name || repeat(')z', p_size) AS text FROM part
      UNION ALL
      SELECT p_partkey, n + 1, regexp_extract(text, '\((.*)\)', 1) FROM step WHERE regexp_extract(text, '\((.*)\)', 1) <> '')
    SELECT p_partkey, max_by(text, n) AS text FROM step GROUP BY p_partkey
    """,
)
def innermost(spark, sf_dir):
    text = F.concat(F.expr("repeat('a(', p_size)"), "p_name", F.expr("repeat(')z', p_size)"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", values.innermost(text, r"\((.*)\)").alias("text")
    )


@query("v13_array_wrap", "SELECT p_partkey, '[\"' || p_name || '\"]' AS names FROM part")
def array_wrap(spark, sf_dir):
    wrapped = values.finished(F.col("p_name"), "string", as_array=True)
    return table(spark, sf_dir, "part").select("p_partkey", F.to_json(wrapped).alias("names"))


@query(
    "v14_typed_columns",
    rf"""
    WITH t AS (SELECT o_orderkey, 'USD ' || format('{{:,.2f}}', o_totalprice) || text || ' 1234 AB on ' || strftime(o_orderdate, '%-d/%-m/%Y') || '  ..' AS text
               FROM orders JOIN {SQL_PRICES} USING (o_orderkey))
    SELECT o_orderkey, TRY_CAST(replace(replace({sql_token("text")}, ',', ''), '.', '') AS BIGINT) AS c_currency,
           CAST(trunc(TRY_CAST(replace({sql_token("text")}, ',', '') AS DOUBLE)) AS BIGINT) AS c_decimal,
           {sql_normal("text")} AS c_string, {sql_date("text")} AS c_date,
           nullif(regexp_extract(text, '\d{{4}} [A-Za-z]{{2}}'), '') AS c_zipcode,
           CASE WHEN regexp_matches(lower(text), '\burgent\b') THEN 'fast' ELSE 'Other Category' END AS c_multivalue,
           text AS c_other
    FROM t
    """,
)
def typed_columns(spark, sf_dir):
    price = F.format_number("o_totalprice", 2)
    text = F.concat(
        F.lit("USD "), price, F.lit("total ("), "o_orderpriority", F.lit("): USD "), price, F.lit(" net."),
        F.lit(" 1234 AB on "), F.date_format("o_orderdate", "d/M/yyyy"), F.lit("  .."),
    )
    source = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    kinds = ("currency", "decimal", "string", "date", "zipcode", "multivalue", "other")
    return source.select(
        "o_orderkey",
        *[
            values.finished(values.typed(F.col("text"), k, {"urgent": "fast"}), k).alias(f"c_{k}")
            for k in kinds
        ],
    )
