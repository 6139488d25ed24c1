"""Column expressions: JSON, hashing, casts, ratios, bands, look-ups, dates."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.arithmetic import (
    band,
    capped_percentage,
    cascading_limit,
    clamp,
    first_positive,
    floor_div,
    guarded_ratio,
    per_event,
    truncated,
    weighted_sum,
    zero_unless,
)
from rowfold.functions.dates import age_in_years, format_date, parse_date
from rowfold.functions.hashing import with_record_hash
from rowfold.functions.lookup import cyclic_pick, lookup
from rowfold.functions.text import csv_text, default_if_null, strip
from rowfold.operators.distinct import partition_counts
from rowfold.operators.projection import as_text, conform, flatten, parse_json, rename, snake_case, with_record
from rowfold.operators.sets import union_all
from rowfold.plans.replay import round_trip
from rowfold.registry import query, table
from rowfold.streaming.messages import parse_messages, unreadable_messages

PROPS = T.StructType([T.StructField("k", T.IntegerType())])


@query(
    "json_extract",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events WHERE props IS NOT NULL",
)
def json_extract(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("json_str"))
    parsed = parse_json(events, PROPS).filter(F.col("data").isNotNull())
    return parsed.select("event_id", "data.*")


@query("json_round_trip", "SELECT * FROM orders")
def json_round_trip(spark, sf_dir):
    return round_trip(table(spark, sf_dir, "orders"))


@query(
    "json_unreadable",
    """SELECT kind, count(*) AS rows FROM (
         SELECT 'unreadable' AS kind FROM documents
         UNION ALL SELECT 'parsed' FROM events UNION ALL SELECT 'parsed' FROM documents) GROUP BY kind""",
)
def json_unreadable(spark, sf_dir):
    """Event properties and plain texts as one message stream: the texts do not parse."""
    texts = table(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("value"))
    props = table(spark, sf_dir, "events").select(F.col("props").cast("binary").alias("value"))
    messages = union_all([texts, props])
    kinds = union_all(
        [
            unreadable_messages(messages, PROPS).select(F.lit("unreadable").alias("kind")),
            parse_messages(messages, PROPS).select(F.lit("parsed").alias("kind")),
        ]
    )
    return partition_counts(kinds, "kind")


HASHED = " || ".join(
    f"'{len(c)}:{c}=' || coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '~')"
    for c in ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
)


@query("record_hash", f"SELECT o_orderkey, sha256({HASHED}) AS record_hash FROM orders")
def order_hashes(spark, sf_dir):
    return with_record_hash(table(spark, sf_dir, "orders")).select("o_orderkey", "record_hash")


@query(
    "text_columns",
    """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size,
         CAST(p_retailprice AS VARCHAR) AS p_retailprice FROM part""",
)
def text_columns(spark, sf_dir):
    return as_text(table(spark, sf_dir, "part"), null_text="None")


@query(
    "csv_rows",
    "SELECT o_orderkey, concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) AS line FROM orders",
)
def csv_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    line = csv_text("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return orders.select("o_orderkey", line.alias("line"))


@query("record_struct", "SELECT p_partkey, p_brand AS brand, p_size AS size FROM part")
def record_struct(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_size").alias("size"))
    return flatten(with_record(parts).select("record"), "record")


@query(
    "rename_conform",
    """SELECT CAST(p_partkey AS INTEGER) AS part_key, p_name AS part_name, CAST(p_size AS DOUBLE) AS size_in_mm,
         p_retailprice AS price FROM part""",
)
def rename_conform(spark, sf_dir):
    shown = rename(
        table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"),
        {
            "p_partkey": "Part-Key",
            "p_name": "Part Name",
            "p_size": "Size (in mm)",
            "p_retailprice": "Recommended Retail Price (%)",
        },
    )
    schema = T.StructType(
        [
            T.StructField("part_key", T.IntegerType()),
            T.StructField("part_name", T.StringType()),
            T.StructField("size_in_mm", T.DoubleType()),
            T.StructField("price", T.DoubleType()),
        ]
    )
    return conform(snake_case(shown, {"Recommended Retail Price (%)": "price"}), schema)


def rounded_sql(value: str, digits: int = 2) -> str:
    """Half-up rounding of the printed decimal, as Spark rounds doubles."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


@query(
    "guarded_ratios",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          {rounded_sql("l_extendedprice / greatest(1, l_quantity)")} AS unit_price,
          {rounded_sql("l_discount / greatest(1, l_tax) * 100")} AS discount_share,
          CASE WHEN l_tax <> 0 THEN {rounded_sql("least(l_discount / l_tax * 100, 100)")} END AS discount_of_tax,
          l_linenumber * 4 + CAST(l_quantity AS INTEGER) * 6 AS weighted,
          l_orderkey // greatest(1, l_linenumber - 2) AS per_line,
          coalesce(nullif(l_linenumber, 3), -1) AS line_or_default
        FROM lineitem""",
)
def guarded_ratios(spark, sf_dir):
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        guarded_ratio(c("l_extendedprice"), c("l_quantity")).alias("unit_price"),
        guarded_ratio(c("l_discount"), c("l_tax"), scale=100).alias("discount_share"),
        capped_percentage(c("l_discount"), c("l_tax")).alias("discount_of_tax"),
        weighted_sum([(c("l_linenumber"), 4), (truncated(c("l_quantity")), 6)]).alias("weighted"),
        per_event(c("l_orderkey"), c("l_linenumber"), F.lit(2)).alias("per_line"),
        default_if_null(F.nullif(c("l_linenumber"), F.lit(3)), -1).alias("line_or_default"),
    )


@query(
    "floor_arith",
    """SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) AS whole,
         CAST(floor(trunc(c_acctbal) / 7) AS BIGINT) AS sevenths,
         CAST(floor(trunc(c_acctbal) / -7) AS BIGINT) AS minus_sevenths,
         greatest(0, least(5000, CAST(trunc(c_acctbal) AS INTEGER))) AS clamped FROM customer""",
)
def floor_arith(spark, sf_dir):
    whole = truncated(F.col("c_acctbal"))
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        whole.alias("whole"),
        floor_div(whole, F.lit(7)).alias("sevenths"),
        floor_div(whole, F.lit(-7)).alias("minus_sevenths"),
        clamp(whole, F.lit(0), F.lit(5000)).alias("clamped"),
    )


@query(
    "band_label",
    """SELECT p_partkey, CASE WHEN p_size BETWEEN 5 AND 15 THEN 'T20' WHEN p_size BETWEEN 16 AND 30 THEN 'ODI'
           WHEN p_size BETWEEN 35 AND 45 THEN 'Test' WHEN p_size >= 49 THEN 'Long' ELSE 'Unknown' END AS band,
         CASE WHEN p_type IN ('PROMO', 'LARGE') THEN p_size ELSE 0 END AS promo_size FROM part""",
)
def band_label(spark, sf_dir):
    bands = [(5, 15, "T20"), (16, 30, "ODI"), (35, 45, "Test"), (49, None, "Long")]
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        band(F.col("p_size"), bands, "Unknown").alias("band"),
        zero_unless(F.col("p_type").isin("PROMO", "LARGE"), F.col("p_size")).alias("promo_size"),
    )


@query(
    "first_nonzero_cascade",
    """SELECT doc_id, CASE WHEN toxic > 0 THEN 200 WHEN quality > 0 THEN 100 ELSE 10 END AS score,
         least(doc_id, CASE WHEN toxic > 0 THEN 7 WHEN quality > 0 THEN 5 ELSE 2 END) AS held FROM labels""",
)
def first_nonzero_cascade(spark, sf_dir):
    toxic, quality = F.col("toxic"), F.col("quality")
    return table(spark, sf_dir, "labels").select(
        "doc_id",
        first_positive([(toxic, F.lit(200)), (quality, F.lit(100))], F.lit(10)).alias("score"),
        cascading_limit(F.col("doc_id"), [(toxic, F.lit(7)), (quality, F.lit(5))], F.lit(2)).alias("held"),
    )


# Fixed values of this example.
TYPE_WORDS = {
    "ECONOMY": ["plain", "bulk"],
    "PROMO": ["offer", "bundle", "gift"],
    "LARGE": ["crate"],
    "SMALL": ["box", "bag", "tube", "pack"],
}


@query(
    "map_lookup",
    """WITH words AS (SELECT * FROM (VALUES ('ECONOMY', ['plain', 'bulk']), ('PROMO', ['offer', 'bundle', 'gift']),
         ('LARGE', ['crate']), ('SMALL', ['box', 'bag', 'tube', 'pack'])) AS t(p_type, w)),
       found AS (SELECT p_partkey, coalesce(w, ['Unknown']) AS w FROM part LEFT JOIN words USING (p_type))
       SELECT p_partkey, len(w) AS choices, w[p_partkey % len(w) + 1] AS word FROM found""",
)
def map_lookup(spark, sf_dir):
    words = lookup(TYPE_WORDS, F.col("p_type"), ["Unknown"])
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.size(words).cast("bigint").alias("choices"),
        cyclic_pick(words, F.col("p_partkey")).alias("word"),
    )


@query(
    "age_years",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day,
         CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2026-01-01') // 365 AS INTEGER) AS age FROM orders""",
)
def age_years(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select("o_orderkey", format_date(F.col("o_orderdate")).alias("day"))
    return days.select("o_orderkey", "day", age_in_years(parse_date(F.col("day")), "2026-01-01").alias("age"))


@query(
    "strip_text",
    r"""SELECT doc_id, regexp_replace(text, '^\s+|\s+$', '', 'g') AS stripped FROM documents""",
)
def strip_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", strip(F.col("text")).alias("stripped"))
