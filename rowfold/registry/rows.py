"""Filters, distinct, membership, unions, sampling, layout, checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions.hashing import RECORD_HASH, hash_text
from rowfold.operators.checks import expect_between, expect_unique
from rowfold.operators.distinct import distinct_rows, keep_first, partition_counts, row_count
from rowfold.operators.filters import (
    equals,
    equals_ignoring_case,
    from_cursor,
    in_range,
    in_values,
    with_normalised_key,
)
from rowfold.operators.joins import already_seen, lookup_dimension, lookup_row, not_seen, upsert
from rowfold.operators.positions import running_totals, with_chunk
from rowfold.operators.sets import (
    inject_duplicates,
    limit,
    materialise,
    poisson_steps,
    sample_with_replacement,
    slice_rows,
    union_all,
)
from rowfold.plans.forest import fit_forest, score
from rowfold.plans.merge import MergeTable, create_table, merge_rows, read_table
from rowfold.registry import query, table, table_path
from rowfold.session import new_work_dir
from rowfold.sinks.clustered import files_within, read_clustered, write_clustered
from rowfold.sinks.tables import plan_text, write_partitioned, write_sorted, write_table
from rowfold.sources.files import local_table, scan_units
from rowfold.sources.footers import row_group_listing

LINE_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
MIX_SQL = """(((({id} * 48271 + {salt} * 40503) % 2147483647) * (({id} * 48271 + {salt} * 40503) % 2147483647)
  % 2147483647 + (({id} * 48271 + {salt} * 40503) % 2147483647) * 16807) % 2147483647)"""


def wide_mix_sql(row_id: str, salt: int) -> str:
    turns = f"({row_id} // 2147483647)"
    second = MIX_SQL.format(id=f"({turns} + {MIX_SQL.format(id=row_id, salt=salt)})", salt=salt + 1)
    return f"({MIX_SQL.format(id=f'({second} + {turns})', salt=salt)} * 2147483647 + {second})"


@query(
    "filter_eq_exact",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def filter_eq_exact(spark, sf_dir):
    rows = equals(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")
    return rows.select("c_custkey", "c_name", "c_mktsegment")


@query(
    "filter_eq_ci",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE lower(trim(c_mktsegment)) = 'building'",
)
def filter_eq_ci(spark, sf_dir):
    rows = equals_ignoring_case(table(spark, sf_dir, "customer"), "c_mktsegment", "Building")
    return rows.select("c_custkey", "c_name", "c_mktsegment")


@query(
    "filter_range_list",
    """SELECT p_partkey, p_type, p_size FROM part
       WHERE p_size BETWEEN 10 AND 30 AND p_type IN ('PROMO', 'SMALL')""",
)
def filter_range_list(spark, sf_dir):
    rows = in_values(in_range(table(spark, sf_dir, "part"), "p_size", 10, 30), "p_type", ["PROMO", "SMALL"])
    return rows.select("p_partkey", "p_type", "p_size")


@query(
    "matching_count",
    "SELECT count(*) AS total_records FROM customer WHERE lower(trim(c_mktsegment)) = 'building'",
)
def matching_count(spark, sf_dir):
    return row_count(equals_ignoring_case(table(spark, sf_dir, "customer"), "c_mktsegment", "building"))


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_line_keys(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "dedup_keep_first",
    """SELECT * EXCLUDE (rn) FROM (
         SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
           ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn
         FROM lineitem) WHERE rn = 1""",
)
def dedup_keep_first(spark, sf_dir):
    return keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE_ORDER)


LABELLED_TEXTS = """
  seen AS (SELECT DISTINCT sha256(text) AS record_hash FROM documents
           WHERE doc_id IN (SELECT doc_id FROM labels)),
  batch AS (SELECT doc_id, sha256(text) AS record_hash FROM documents
            WHERE doc_id NOT IN (SELECT doc_id FROM labels))
"""


def _texts(spark, sf_dir):
    """Hashes of labelled documents, and the other documents with theirs."""
    documents = table(spark, sf_dir, "documents").select("doc_id", hash_text(F.col("text")).alias(RECORD_HASH))
    labels = table(spark, sf_dir, "labels").select("doc_id")
    seen = distinct_rows(already_seen(documents, labels, "doc_id").select(RECORD_HASH))
    return not_seen(documents, labels, "doc_id"), seen


@query(
    "seen_semi",
    f"WITH {LABELLED_TEXTS} SELECT doc_id, record_hash FROM batch WHERE record_hash IN (SELECT record_hash FROM seen)",
)
def seen_semi(spark, sf_dir):
    batch, seen = _texts(spark, sf_dir)
    return already_seen(batch, seen, RECORD_HASH).select("doc_id", RECORD_HASH)


@query(
    "seen_anti",
    f"""WITH {LABELLED_TEXTS}
    SELECT doc_id, record_hash FROM batch WHERE record_hash NOT IN (SELECT record_hash FROM seen)""",
)
def seen_anti(spark, sf_dir):
    batch, seen = _texts(spark, sf_dir)
    return not_seen(batch, seen, RECORD_HASH).select("doc_id", RECORD_HASH)


@query(
    "state_upsert",
    """WITH new AS (SELECT o_custkey AS task, count(*) AS total_records, 'DONE' AS status FROM orders GROUP BY o_custkey)
       SELECT c_custkey AS task, CAST(0 AS BIGINT) AS total_records, 'PENDING' AS status FROM customer
       WHERE c_custkey NOT IN (SELECT task FROM new)
       UNION ALL SELECT task, total_records, status FROM new""",
)
def state_upsert(spark, sf_dir):
    old = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("task"),
        F.lit(0).cast("bigint").alias("total_records"),
        F.lit("PENDING").alias("status"),
    )
    new = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("task"))
        .agg(F.count("*").alias("total_records"))
        .withColumn("status", F.lit("DONE"))
    )
    return upsert(old, new, "task")


@query(
    "state_lookup",
    """SELECT p_partkey, p_name, p_size FROM part WHERE p_partkey = 7
       UNION ALL SELECT -1, 'none', 0""",
)
def state_lookup(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    default = {"p_partkey": -1, "p_name": "none", "p_size": 0}
    return union_all([lookup_row(parts, "p_partkey", key, default) for key in (7, -5)])


@query(
    "dimension_lookup",
    """SELECT c_custkey, n_name, r_name FROM customer
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
def dimension_lookup(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    placed = lookup_dimension(customers, nations, "n_nationkey")
    return lookup_dimension(placed, table(spark, sf_dir, "region"), "r_regionkey").select(
        "c_custkey", "n_name", "r_name"
    )


@query(
    "running_totals",
    """WITH report AS (
         SELECT CAST(year(o_orderdate) AS BIGINT) AS row_group, CAST(month(o_orderdate) AS BIGINT) AS chunk,
                count(*) AS rows, count(DISTINCT o_custkey) AS new FROM orders GROUP BY 1, 2)
       SELECT *, CAST(sum(rows) OVER w AS BIGINT) AS total_rows, CAST(sum(new) OVER w AS BIGINT) AS total_new
       FROM report WINDOW w AS (ORDER BY row_group, chunk)""",
)
def running_totals_by_month(spark, sf_dir):
    report = (
        table(spark, sf_dir, "orders")
        .groupBy(
            F.year("o_orderdate").cast("bigint").alias("row_group"),
            F.month("o_orderdate").cast("bigint").alias("chunk"),
        )
        .agg(F.count("*").alias("rows"), F.countDistinct("o_custkey").alias("new"))
    )
    return running_totals(report, ["rows", "new"], block=4)


CHUNKED_LINES = """
  SELECT *, (row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey,
    l_extendedprice) - 1) // 10000 AS chunk FROM lineitem
"""


@query(
    "chunk_slice",
    f"SELECT l_orderkey, l_linenumber, l_shipdate, chunk FROM ({CHUNKED_LINES}) WHERE chunk = 1",
)
def chunk_slice(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_ORDER)
    chunk = slice_rows(with_chunk(lines, LINE_ORDER, 10_000), 1)
    return chunk.select("l_orderkey", "l_linenumber", "l_shipdate", "chunk")


@query(
    "cursor_filter",
    """SELECT year(o_orderdate) AS row_group, month(o_orderdate) AS chunk, count(*) AS rows FROM orders
       WHERE year(o_orderdate) > 1997 OR (year(o_orderdate) = 1997 AND month(o_orderdate) >= 6) GROUP BY 1, 2""",
)
def cursor_filter(spark, sf_dir):
    dated = table(spark, sf_dir, "orders").select(
        F.year("o_orderdate").cast("bigint").alias("row_group"), F.month("o_orderdate").cast("bigint").alias("chunk")
    )
    return partition_counts(from_cursor(dated, "row_group", "chunk", 1997, 6), "row_group", "chunk")


@query(
    "union_batches",
    """SELECT s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal FROM supplier
       UNION ALL SELECT c_name, c_nationkey, c_acctbal FROM customer""",
)
def union_batches(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal")
    )
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_acctbal").alias("acctbal"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey")
    )
    debt, small = F.col("acctbal") < 0, F.col("acctbal").between(0, 5000)
    parts = [suppliers.filter(debt), suppliers.filter(small), suppliers.filter(~debt & ~small), customers]
    return union_all(parts)


SAMPLE_STEPS = poisson_steps(0.1)


@query(
    "sample_replace",
    f"""WITH draws AS (SELECT l_orderkey, l_linenumber, l_suppkey, {wide_mix_sql("(l_orderkey * 10 + l_linenumber)", 5)} AS draw FROM lineitem),
        times AS (SELECT *, {" + ".join(f"(draw >= {s})::INT" for s in SAMPLE_STEPS)} AS n FROM draws)
       SELECT l_orderkey, l_linenumber, l_suppkey FROM (SELECT *, unnest(range(n)) FROM times)""",
)
def sample_replace(spark, sf_dir):
    """About a tenth of the lines, some of them several times: the same rows in any engine and any partitioning."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return sample_with_replacement(lines, 0.1, 5, F.col("l_orderkey") * 10 + F.col("l_linenumber"))


@query(
    "inject_duplicates",
    f"""WITH numbered AS (SELECT *, row_number() OVER (ORDER BY p_partkey) - 1 AS pos FROM part),
        draws AS (SELECT {wide_mix_sql("i", 1)} % (SELECT count(*) FROM part) AS pos
                  FROM (SELECT CAST(pos AS BIGINT) AS i FROM numbered
                        WHERE pos < (SELECT count(*) // 9 FROM part)))
        SELECT * FROM part
        UNION ALL SELECT numbered.* EXCLUDE (pos) FROM numbered JOIN draws USING (pos)""",
)
def duplicated_parts(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return inject_duplicates(parts, ["p_partkey"], parts.count() // 9)


@query(
    "limit_top",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
)
def limit_top(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return limit(orders, 100, [F.desc("o_totalprice"), "o_orderkey"])


@query("partition_counts", "SELECT c_mktsegment, count(*) AS rows FROM customer GROUP BY c_mktsegment")
def segment_counts(spark, sf_dir):
    return partition_counts(table(spark, sf_dir, "customer"), "c_mktsegment")


@query(
    "partition_prune",
    "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'",
)
def partition_prune(spark, sf_dir):
    path = new_work_dir(spark, "by-segment")
    write_partitioned(table(spark, sf_dir, "customer"), path, ["c_mktsegment"])
    return equals(spark.read.parquet(path), "c_mktsegment", "BUILDING").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )


@query(
    "normalised_key",
    "SELECT c_custkey, lower(trim(c_mktsegment)) AS segment_key FROM customer WHERE lower(trim(c_mktsegment)) = 'machinery'",
)
def normalised_key(spark, sf_dir):
    path = new_work_dir(spark, "with-key")
    keyed = with_normalised_key(table(spark, sf_dir, "customer"), "c_mktsegment", "segment_key")
    write_partitioned(keyed, path, ["segment_key"])
    return equals(spark.read.parquet(path), "segment_key", "machinery").select("c_custkey", "segment_key")


@query(
    "sorted_layout",
    """SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity FROM lineitem
       WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-03-31'""",
)
def sorted_layout(spark, sf_dir):
    path = new_work_dir(spark, "by-shipdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    write_sorted(lines, path, ["l_shipdate"], bloom_columns=["l_orderkey"], cluster=True)
    first, last = (F.to_timestamp_ntz(F.lit(f"{day} 00:00:00")) for day in ("1997-01-01", "1997-03-31"))
    return in_range(spark.read.parquet(path), "l_shipdate", first, last)


@query("scan_units", "SELECT CAST(1 AS BIGINT) AS files, count(*) AS rows FROM lineitem")
def line_scan_units(spark, sf_dir):
    units = scan_units(spark.read.parquet(table_path(sf_dir, "lineitem")))
    return units.agg(
        F.countDistinct("file_path").alias("files"), F.sum("rows").alias("rows")
    )


@query(
    "expect_between",
    """SELECT count(*) AS evaluated, count(*) FILTER (c_acctbal IS NULL) AS nulls,
         count(*) FILTER (NOT c_acctbal BETWEEN 0 AND 9000) AS unexpected,
         round(CAST(count(*) FILTER (NOT c_acctbal BETWEEN 0 AND 9000) * 100 AS DOUBLE)
           / count(c_acctbal), 4) AS unexpected_percent,
         count(*) FILTER (NOT c_acctbal BETWEEN 0 AND 9000) = 0 AS success
       FROM customer""",
)
def balance_in_range(spark, sf_dir):
    return expect_between(table(spark, sf_dir, "customer"), "c_acctbal", 0, 9000)


@query(
    "expect_unique",
    """SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS distinct_rows,
         count(*) = count(DISTINCT o_orderkey) AS success FROM orders
       UNION ALL
       SELECT count(*), (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
         count(*) = (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) FROM lineitem""",
)
def unique_keys(spark, sf_dir):
    orders = expect_unique(table(spark, sf_dir, "orders"), ["o_orderkey"])
    return orders.unionByName(expect_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]))


@query(
    "forest_fit_score",
    """SELECT count(*) AS scored, 0::BIGINT AS unscored, true AS in_label_range, true AS better_than_mean
       FROM lineitem""",
)
def forest_fit_score(spark, sf_dir):
    """Checks of scores for all lines: one each, within the range of the label, nearer to it than its mean."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice"
    )
    model = fit_forest(lines, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", trees=5, depth=4, seed=7)
    label, told = F.col("l_extendedprice"), F.col("prediction")
    return score(model, lines).agg(
        F.count("*").alias("scored"),
        F.count_if(told.isNull()).alias("unscored"),
        ((F.min(told) >= F.min(label)) & (F.max(told) <= F.max(label))).alias("in_label_range"),
        (F.avg((label - told) ** 2) < F.var_pop(label)).alias("better_than_mean"),
    )


@query(
    "file_counts",
    """SELECT count(*) AS rows, 1::BIGINT AS single_files, true AS capped_files, true AS same_rows FROM customer""",
)
def file_counts(spark, sf_dir):
    """A table written over as one file, then by rows per file, from one materialised result."""
    # a task writes its files one after the other
    dealt = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment").repartition(max(4, spark.sparkContext.defaultParallelism))
    customers = materialise(dealt)
    path = new_work_dir(spark, "files")
    write_table(customers, f"{path}/t", "overwrite", max_records_per_file=100)
    many = scan_files(spark, f"{path}/t")
    write_table(customers, f"{path}/t", "overwrite", num_files=1)
    single = scan_files(spark, f"{path}/t")
    rows = customers.count()
    return spark.read.parquet(f"{path}/t").agg(
        F.count("*").alias("rows"),
        F.lit(single).cast("bigint").alias("single_files"),
        F.lit(many >= rows // 100).alias("capped_files"),
        (F.countDistinct("c_custkey") == rows).alias("same_rows"),
    )


def scan_files(spark, path) -> int:
    return scan_units(spark.read.parquet(path)).select("file_path").distinct().count()


# Lines of a file, about.
LISTED_ROWS = 500_000


@query(
    "row_group_listing",
    "SELECT count(*) AS rows, true AS groups_are_cut, true AS bounds_hold, true AS positions_follow FROM lineitem",
)
def listed_row_groups(spark, sf_dir):
    """The lines in files of several row groups, by their footers: rows, and what the footers say against the rows themselves."""
    path = new_work_dir(spark, "row-groups")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    # files and the sorts behind them keep their size however many lines there are
    files = max(4, -(-lines.count() // LISTED_ROWS))
    lines.repartition(files, "l_orderkey").sortWithinPartitions("l_orderkey").write.option("parquet.block.size", 256 << 10).parquet(path)
    groups = row_group_listing(spark, path, "l_orderkey")
    held = spark.read.parquet(path).select("l_orderkey", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("at"))
    inside = (held["at"] >= groups["first_row"]) & (held["at"] < groups["first_row"] + groups["rows"])
    # a row for each row group: the rows themselves are neither shuffled nor sorted
    met = held.join(F.broadcast(groups), (held["file_path"] == groups["file_path"]) & inside).groupBy(groups["file_path"], "row_group")
    told = met.agg(
        F.count("*").alias("found"), F.first("rows").alias("rows"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high"),
        # as numbers: texts would make the aggregate sort all rows
        F.first(F.col("least").cast("bigint")).alias("least"), F.first(F.col("most").cast("bigint")).alias("most"),
    )
    return told.agg(
        F.sum("rows").alias("rows"),
        (F.count("*") >= F.countDistinct("file_path")).alias("groups_are_cut"),
        F.bool_and((F.col("low") == F.col("least")) & (F.col("high") == F.col("most"))).alias("bounds_hold"),
        F.bool_and(F.col("found") == F.col("rows")).alias("positions_follow"),
    )


CURVED = ["l_partkey", "l_suppkey", "l_shipdate"]


@query(
    "clustered_layout",
    """WITH ends AS (SELECT max(l_partkey) // 20 AS part, max(l_suppkey) // 20 AS supp,
          min(l_shipdate) + INTERVAL 120 DAY AS ship FROM lineitem)
       SELECT 'l_partkey' AS "column", l_orderkey, l_linenumber, true AS few_files FROM lineitem, ends WHERE l_partkey <= part
       UNION ALL SELECT 'l_suppkey', l_orderkey, l_linenumber, true FROM lineitem, ends WHERE l_suppkey <= supp
       UNION ALL SELECT 'l_shipdate', l_orderkey, l_linenumber, true FROM lineitem, ends WHERE l_shipdate <= ship""",
)
def clustered_layout(spark, sf_dir):
    """The lines along a curve over three columns: about a twentieth by a filter on each, from under a third of the files."""
    path = new_work_dir(spark, "clustered")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *CURVED)
    write_clustered(lines, path, CURVED, files=256)
    files = spark.read.parquet(path).select("_metadata.file_path").distinct().count()
    ends = {"l_partkey": "max(l_partkey) div 20", "l_suppkey": "max(l_suppkey) div 20", "l_shipdate": "min(l_shipdate) + INTERVAL 120 DAY"}
    ends = lines.agg(*[F.expr(e).alias(c) for c, e in ends.items()]).first()
    parts = []
    for c in CURVED:
        few = 3 * len(files_within(spark, path, {c: (None, ends[c])})) < files
        found = read_clustered(spark, path, **{c: (None, ends[c])})
        parts.append(found.select(F.lit(c).alias("column"), "l_orderkey", "l_linenumber", F.lit(few).alias("few_files")))
    return union_all(parts)


@query(
    "merge_upsert",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey BETWEEN 1000 AND 1999 THEN 'X' ELSE o_orderstatus END AS o_orderstatus
       FROM orders WHERE o_orderstatus <> 'P' OR o_orderkey BETWEEN 1000 AND 1999""",
)
def merge_upsert(spark, sf_dir):
    """All orders but the pending ones, then the orders of a range of keys with another status, some of them new."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    held = MergeTable(new_work_dir(spark, "merged"), ("o_orderkey",), file_rows=max(1, orders.count() // 64))
    create_table(orders.filter("o_orderstatus <> 'P'"), held)
    merge_rows(orders.filter("o_orderkey BETWEEN 1000 AND 1999").withColumn("o_orderstatus", F.lit("X")), held)
    return read_table(spark, held)


FLAGS = [("R", "returned"), ("A", "accepted"), ("N", "none yet")]


@query(
    "local_rows",
    f"""SELECT name, count(*) AS lines FROM lineitem JOIN (VALUES {", ".join(map(repr, FLAGS))}) AS f(flag, name)
       ON l_returnflag = flag GROUP BY name""",
)
def local_rows(spark, sf_dir):
    """The lines of each return flag by names from local rows."""
    names = local_table(spark, FLAGS, T.StructType([T.StructField("flag", T.StringType()), T.StructField("name", T.StringType())]))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("flag"))
    return lines.join(names, "flag").groupBy("name").agg(F.count("*").alias("lines"))


@query("explained", "SELECT count(*) AS lines, true AS filter_is_pushed, true AS columns_are_pruned FROM lineitem WHERE l_quantity > 30")
def explained(spark, sf_dir):
    """A count beside what the text of its plan says about the scan."""
    lines = table(spark, sf_dir, "lineitem").filter("l_quantity > 30").select("l_orderkey")
    text = plan_text(lines)
    pushed, pruned = "GreaterThan(l_quantity,30" in text, "l_comment" not in text
    return lines.agg(F.count("*").alias("lines")).select("lines", F.lit(pushed).alias("filter_is_pushed"), F.lit(pruned).alias("columns_are_pruned"))
