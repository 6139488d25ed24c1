"""Operators and column expressions on small fixtures, edge cases and plan checks."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowfold.functions import arithmetic as A
from rowfold.functions import seeded
from rowfold.functions.dates import age_in_years, format_date, parse_date
from rowfold.functions.hashing import quote, record_hash, with_record_hash
from rowfold.functions.lookup import literal_array, lookup
from rowfold.functions.text import json_text, normalised, parsed, strip
from rowfold.operators import checks, distinct, filters, joins, positions, projection, sets
from rowfold.plans import players
from rowfold.plans.forest import fit_forest, load_model, save_model, score
from rowfold.plans.replay import round_trip
from rowfold.sinks import messages as message_sink
from rowfold.sinks import tables
from rowfold.sources import files, jdbc
from rowfold.sources import messages as message_source

SF_DIR = "/root/testdata/sf0.001"
FORMATS = [(30, 60, "Test"), (61, 90, "ODI"), (90, None, "T20")]


def values(df, column="v"):
    return [r[column] for r in df.collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_hash_tells_nulls_and_separators_apart(spark):
    rows = [(None, "a"), ("a", None), ("", "a"), ("a", ""), ("1:a", ""), ("", "1:a"), ("~", "a"), (None, None)]
    df = spark.createDataFrame(rows, "x string, y string")
    for algorithm in ("sha256", "md5", "xxhash64"):
        assert len(set(values(df.select(record_hash(df, algorithm=algorithm).alias("v"))))) == len(rows)
    with pytest.raises(ValueError):
        record_hash(df, algorithm="none")


def test_hash_covers_nested_binary_and_time_columns(spark):
    df = spark.sql(
        "SELECT array('a, b') v, map('k', 1) m, X'00FF' b, named_struct('p', 1, 'q', cast(null as int)) s,"
        " timestamp'2024-01-01 00:00:00' t UNION ALL SELECT array('a', 'b'), map('k', 1), X'00FF',"
        " named_struct('p', 1, 'q', cast(null as int)), timestamp'2024-01-01 00:00:00'"
    )
    assert len(set(values(df.select(record_hash(df).alias("v"))))) == 2
    assert len(set(values(df.select(record_hash(df, ["m", "b", "s", "t"], as_hex=False).alias("v"))))) == 1


def test_hash_of_a_row_is_not_computed_twice_in_a_join(spark):
    df = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey", "o_custkey")
    hashed = with_record_hash(df, as_hex=False)
    joined = joins.already_seen(hashed, hashed.select("record_hash").distinct(), "record_hash")
    assert "isnotnull(unhex" not in tables.plan_text(joined)


@pytest.mark.parametrize(("a", "b"), [(7, 2), (-7, 2), (7, -2), (-7, -2), (6, 3), (-6, 3), (0, 5), (2**60 + 1, 3)])
def test_floor_division(spark, a, b):
    assert one(spark, A.floor_div(F.lit(a), F.lit(b))) == a // b


def test_guards(spark):
    assert one(spark, A.guarded_ratio(F.lit(5), F.lit(0))) == 5.0
    assert one(spark, A.guarded_ratio(F.lit(1), F.lit(3), scale=100)) == 33.33
    assert one(spark, A.capped_percentage(F.lit(9), F.lit(4))) == 100.0
    assert one(spark, A.capped_percentage(F.lit(9), F.lit(0))) is None
    assert one(spark, A.truncated(F.lit(-3.9))) == -3
    assert one(spark, A.clamp(F.lit(9), F.lit(0), F.lit(4))) == 4
    assert one(spark, A.clamp(F.lit(9), F.lit(0), F.lit(-1))) == 0
    assert one(spark, A.per_event(F.lit(10), F.lit(3), F.lit(3))) == 10
    assert one(spark, A.zero_unless(F.lit(None).cast("boolean"), F.lit(4))) == 0


@pytest.mark.parametrize(
    ("value", "label"),
    [(29, "Unknown"), (30, "Test"), (60, "Test"), (60.5, "Unknown"), (61, "ODI"), (90, "ODI"), (90.1, "T20"), (None, "Unknown")],
)
def test_bands_with_gaps(spark, value, label):
    column = F.lit(value).cast("double")
    assert one(spark, A.band(column, FORMATS, "Unknown")) == label


def test_cascades(spark):
    choices = [(F.lit(0), F.lit(7)), (F.lit(2), F.lit(5))]
    assert one(spark, A.first_positive(choices, F.lit(1))) == 5
    assert one(spark, A.cascading_limit(F.lit(9), choices, F.lit(1))) == 5
    assert one(spark, A.cascading_limit(F.lit(3), choices, F.lit(1))) == 3


def test_text_and_dates(spark):
    assert one(spark, normalised(F.lit("  InDia "))) == "india"
    assert one(spark, normalised(F.lit("india\t"))) == "india\t"
    assert one(spark, strip(F.lit("\t a b\n "))) == "a b"
    born = parse_date(F.lit("2000-01-01"))
    assert one(spark, age_in_years(born, "2000-12-31")) == 1
    assert one(spark, age_in_years(born, "2000-12-30")) == 0
    assert one(spark, format_date(born)) == "2000-01-01"
    assert one(spark, lookup({"Bowler": ["Accuracy"]}, F.lit("Nobody"), ["Unknown"])) == ["Unknown"]
    assert one(spark, literal_array(["a", "b c"])) == ["a", "b c"]
    assert quote("a`b") == "`a``b`"


def test_json_edges(spark):
    schema = T.StructType([T.StructField("country", T.StringType()), T.StructField("runs", T.IntegerType())])
    texts = ['{"country":" INDIA ","runs":1}', '{"country":"x","runs":"y"}', "not json", "{}", '{"Country":"a"}', "", None]
    df = spark.createDataFrame([(t,) for t in texts], "json_str string")
    rows = projection.parse_json(df, schema).select("data").collect()
    assert [r["data"] is None for r in rows] == [False] * 5 + [True, True]
    assert (rows[1]["data"]["country"], rows[1]["data"]["runs"]) == ("x", None)
    assert rows[4]["data"]["country"] is None
    bad = df.select(parsed(F.col("json_str"), schema, "_bad").alias("d")).select("d._bad")
    assert [r[0] for r in bad.collect()][2] == "not json"
    matched = filters.equals_ignoring_case(projection.flatten(projection.parse_json(df, schema)), "country", "india ")
    assert matched.count() == 1
    assert one(spark, json_text(F.lit(None).cast("int").alias("a"))) == '{"a":null}'


def test_round_trip_keeps_every_type(spark):
    df = spark.sql(
        "SELECT 1 AS i, cast(null AS string) AS s, 2.5D AS d, timestamp_ntz'2024-01-01 00:00:07.179575' AS ts,"
        " date'2020-02-29' AS day, array(1, null) AS a, 9007199254740993L AS big"
    )
    assert round_trip(df).collect() == df.collect()


def test_display_names_and_conform(spark):
    shown = spark.createDataFrame([], players.player_schema(display_names=True))
    renamed = projection.snake_case(shown, players.SHORT_NAMES)
    assert renamed.columns == players.player_schema().fieldNames()
    assert len(renamed.columns) == 50
    widened = projection.conform(renamed, players.player_schema(widened=True))
    assert {f.name for f in widened.schema if f.dataType == T.DoubleType()} >= set(players.WIDENED)
    with pytest.raises(ValueError):
        projection.snake_case(spark.createDataFrame([], "`A b` int, `a-b` int"))


def test_display_names_survive_parquet(spark, tmp_path):
    made = spark.range(40).select(
        *[F.col("id").cast(kind).alias(name) for name, kind in players.FIELDS]
    )
    tables.write_table(made, f"{tmp_path}/t", num_files=1)
    back = spark.read.parquet(f"{tmp_path}/t")
    assert back.columns == [d for d, _ in players.FIELDS]
    assert sorted(back.collect()) == sorted(made.collect())
    assert len(list((tmp_path / "t").glob("*.parquet"))) == 1


def test_draws_are_spread_and_independent(spark):
    draws = spark.range(20_000).select(
        seeded.mix(F.col("id"), 0).alias("a"), seeded.mix(F.col("id"), 1).alias("b")
    )
    cells = draws.groupBy((F.col("a") % 4).alias("x"), (F.col("b") % 5).alias("y")).count()
    counts = values(cells, "count")
    assert len(counts) == 20 and min(counts) > 800 and max(counts) < 1200


def test_draws_reach_tables_and_ids_of_any_size(spark):
    """Places beyond 2^31 are drawn, and ids that the first mix cannot tell apart are."""
    size = 1 << 40
    ids = spark.range(0, 4000).select((F.col("id") * seeded.MODULUS).alias("id"))
    places = [p % size for p in values(ids.select(seeded.wide_mix(F.col("id"), 1).alias("v")))]
    assert len(set(places)) == 4000 and max(places) > 0.99 * size and min(places) < 0.01 * size


def test_positions_match_a_sort(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(50)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, k long").repartition(6)
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    got = {r["id"]: r["position"] for r in positions.row_positions(df, [F.desc("k"), "id"]).collect()}
    assert got == {r[0]: i for i, r in enumerate(expected)}


def test_running_totals_cross_blocks(spark):
    rows = [(g, c, g * 10 + c) for g in range(3) for c in range(7)]
    df = spark.createDataFrame(rows, "row_group long, chunk long, n long").repartition(5)
    out = positions.running_totals(df, ["n"], block=3).orderBy("row_group", "chunk")
    total, want = 0, []
    for r in rows:
        total += r[2]
        want.append(total)
    assert values(out, "total_n") == want


def test_keep_first_drops_copies_in_map_tasks(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (2, 2, "b"), (None, 1, "n"), (None, 2, "m")], "k int, o int, v string")
    kept = distinct.keep_first(df, ["k"], ["o"])
    assert sorted(values(kept)) == ["a", "b", "n"]
    plan = distinct.keep_first(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"), ["l_orderkey"], ["l_shipdate"])
    text = tables.plan_text(plan, "simple")
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_duplicates_injected_then_removed(spark):
    df = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    more = sets.inject_duplicates(df, ["k"], 37)
    assert more.count() == 137
    assert sorted(map(tuple, more.distinct().collect())) == sorted(map(tuple, df.collect()))
    assert sets.duplicates(df, ["k"], 1000, salt=4).count() == 1000
    assert sets.duplicates(df, ["k"], 0).count() == 0
    assert sets.inject_duplicates(df.limit(0), ["k"], 5).count() == 0


def test_sets(spark):
    df = spark.range(10).select(F.col("id").alias("v"))
    assert sets.union_all([df, df, df]).count() == 30
    with pytest.raises(ValueError):
        sets.union_all([])
    assert values(sets.limit(df, 3, [F.desc("v")])) == [9, 8, 7]
    assert "TakeOrderedAndProject" in tables.plan_text(sets.limit(df, 3, ["v"]), "simple")
    assert sorted(values(sets.first_rows(df, 3, [F.desc("v")]))) == [7, 8, 9]
    assert sets.materialise(df).count() == 10
    first = sets.sample_with_replacement(df, 0.5, 1).collect()
    assert first == sets.sample_with_replacement(df, 0.5, 1).collect()
    chunked = positions.with_chunk(df, ["v"], 4)
    assert sorted(values(sets.slice_rows(chunked, 2))) == [8, 9]


def test_duplicates_move_keys_not_rows(spark):
    df = spark.createDataFrame([(k if k else None, "x" * k) for k in range(50)], "k int, v string")
    extra = sets.duplicates(df, ["k"], 40)
    assert extra.count() == 40 and extra.join(df, ["k", "v"], "left_semi").count() >= 39
    assert extra.columns == df.columns


def test_joins(spark):
    batch = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "h string, v int")
    seen = spark.createDataFrame([("a",), ("z",)], "h string")
    assert values(joins.already_seen(batch, seen, "h")) == [1]
    assert sorted(values(joins.not_seen(batch, seen, "h"))) == [2, 3]
    new = spark.createDataFrame([("a", 9), ("c", 8)], "h string, v int")
    merged = joins.upsert(batch.filter("h IS NOT NULL"), new, "h")
    assert sorted(map(tuple, merged.collect())) == [("a", 9), ("b", 2), ("c", 8)]
    default = {"h": "none", "v": 0}
    assert tuple(joins.lookup_row(batch, "h", "b", default).first()) == ("b", 2)
    assert tuple(joins.lookup_row(batch, "h", "q", default).first()) == ("none", 0)
    stored_null = spark.createDataFrame([("k", None)], "h string, v int")
    assert tuple(joins.lookup_row(stored_null, "h", "k", default).first()) == ("k", None)
    with pytest.raises(Exception, match="stored twice"):
        joins.lookup_row(batch.union(batch), "h", "b", default).first()
    plan = tables.plan_text(joins.lookup_row(batch, "h", "b", default), "simple")
    assert "Join" not in plan


def test_no_join_is_broadcast_beyond_the_threshold(spark):
    big = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        plan = tables.plan_text(joins.not_seen(big, big.select("l_orderkey"), "l_orderkey"), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_cursor(spark):
    df = spark.createDataFrame([(g, c) for g in range(3) for c in range(3)], "g int, c int")
    kept = filters.from_cursor(df, "g", "c", 1, 2).collect()
    assert sorted(map(tuple, kept)) == [(1, 2), (2, 0), (2, 1), (2, 2)]


def test_expectations(spark):
    df = spark.createDataFrame([(1.0,), (None,), (101.0,), (50.0,)], "v double")
    row = checks.expect_between(df, "v", 0, 100).first()
    assert tuple(row) == (4, 1, 1, 33.3333, False)
    assert tuple(checks.expect_between(df.filter("v IS NULL"), "v", 0, 1).first()) == (1, 1, 0, 0.0, True)
    assert checks.expect_between(df.limit(0), "v", 0, 1).first()["success"]
    assert tuple(checks.expect_unique(df, ["v"]).first()) == (4, 4, True)
    assert tuple(checks.expect_unique(df.union(df), ["v"]).first()) == (8, 4, False)
    keys = spark.range(5000).select((F.col("id") % 1000).alias("k"), F.lit(None).cast("int").alias("n"))
    assert abs(checks.approximate_distinct(keys, ["k", "n"]).first()["distinct_rows"] - 1000) < 60


def test_filters_and_columns_reach_the_scan(spark):
    customers = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    plan = tables.plan_text(filters.equals(customers, "c_mktsegment", "BUILDING").select("c_custkey"))
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "struct<c_custkey:bigint,c_mktsegment:string>" in plan


def test_partitions_are_pruned(spark, tmp_path):
    customers = spark.read.parquet(f"{SF_DIR}/customer.parquet")
    tables.write_partitioned(customers, f"{tmp_path}/p", ["c_mktsegment"])
    stored = spark.read.parquet(f"{tmp_path}/p")
    plan = tables.plan_text(filters.equals(stored, "c_mktsegment", "BUILDING"))
    assert "PartitionFilters: [isnotnull(c_mktsegment" in plan
    assert stored.count() == customers.count()
    counts = {r[0]: r[1] for r in distinct.partition_counts(stored, "c_mktsegment").collect()}
    assert sum(counts.values()) == customers.count()


def test_sorted_and_bucketed_layouts(spark, tmp_path):
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_orderkey", "l_shipdate")
    tables.write_sorted(lines, f"{tmp_path}/s", ["l_shipdate"], bloom_columns=["l_orderkey"])
    assert spark.read.parquet(f"{tmp_path}/s").count() == lines.count()
    hot = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_sorted(hot, f"{tmp_path}/hot", ["k"], cluster=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(f"{tmp_path}/hot")
    shares = stored.groupBy(F.col("_metadata.file_path")).count()
    assert stored.count() == 8000 and shares.count() > 3
    for name in ("left_lines", "right_lines"):
        tables.write_bucketed(lines, name, f"{tmp_path}/{name}", "l_orderkey", 4)
    joined = joins.already_seen(spark.table("left_lines"), spark.table("right_lines"), "l_orderkey")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in tables.plan_text(joined, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("left_lines", "right_lines"):
            spark.sql(f"DROP TABLE {name}")


def test_sources(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    assert files.read_or_empty(spark, f"{tmp_path}/none", schema).count() == 0
    local = files.local_table(spark, [(1,), (2,)], schema)
    tables.write_table(local, f"{tmp_path}/t")
    tables.write_table(local, f"{tmp_path}/t")
    assert files.read_or_empty(spark, f"{tmp_path}/t", schema).count() == 4
    assert files.read_parquet(spark, f"{tmp_path}/t", schema=schema).count() == 4
    units = files.scan_units(spark.read.parquet(f"{tmp_path}/t"))
    assert units.agg(F.sum("rows")).first()[0] == 4
    assert "ReadSchema: struct<>" in tables.plan_text(units)
    groups = files.row_groups(spark.read.parquet(f"{tmp_path}/t"))
    assert sorted(values(groups, "row_group")) == list(range(groups.count()))


def test_file_positions(spark, tmp_path):
    spark.range(20).repartition(4).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    groups = files.row_groups(df)
    placed = files.with_file_position(df, groups, 4)
    assert placed.select("position").distinct().count() == 20
    some = files.with_file_position(df, groups.filter("row_group >= 2"), 2)
    assert {p >> 40 for p in values(some, "position")} == {2, 3}
    with pytest.raises(ValueError):
        files.with_file_position(df, groups, files.MOST_FILES + 1)


def test_a_file_range_reads_only_its_files(spark, tmp_path):
    spark.range(0, 80, 1, 8).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    paths = sorted(values(df.select(F.col(files.FILE_PATH).alias("v")).distinct()))
    part = df.filter(F.col(files.FILE_PATH).between(paths[5], paths[6]))
    assert part.count() == 20
    part.collect()
    scan = part._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().apply(0)
    assert scan.metrics().apply("numFiles").value() == 2


def test_connector_options():
    ranged = jdbc.read_options("jdbc:x", "t", "id", 0, 100, 8)
    assert ranged["fetchsize"] == "50000" and ranged["numPartitions"] == "8"
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "t", partition_column="id")
    earliest = message_source.kafka_options("h:1", "t")
    assert (earliest["startingOffsets"], earliest["maxOffsetsPerTrigger"]) == ("earliest", "100000")
    latest = message_source.kafka_options("h:1", "t", "latest", None)
    assert latest["startingOffsets"] == "latest" and "maxOffsetsPerTrigger" not in latest
    assert message_sink.kafka_write_options("h:1", "t")["kafka.batch.size"] == "32768"


def test_forest_learns_and_survives_saving(spark, tmp_path):
    df = spark.range(400).select(
        (F.col("id") % 20).cast("double").alias("x"), ((F.col("id") % 20) * 3.0).alias("y")
    )
    model = fit_forest(df, ["x"], "y", trees=5, depth=5, seed=1)
    error = score(model, df).agg(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert error < 3
    save_model(model, f"{tmp_path}/m")
    again = score(load_model(f"{tmp_path}/m"), df)
    assert again.agg(F.sum("prediction")).first() == score(model, df).agg(F.sum("prediction")).first()


def test_forest_scores_every_row(spark):
    rows = [(float(i), None if i % 4 == 0 else float(i % 7), 2.0 * i) for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    scored = score(fit_forest(df, ["a", "b"], "y", trees=3, depth=3), df)
    assert scored.count() == 100
    assert scored.filter("prediction IS NULL").count() == 25 == scored.filter("b IS NULL AND prediction IS NULL").count()


def test_hash_does_not_depend_on_column_order_but_on_names(spark):
    df = spark.createDataFrame([("x", "y")], "a string, b string")
    same, swapped = record_hash(df, ["a", "b"]), record_hash(df, ["b", "a"])
    renamed = df.toDF("c", "d")
    assert df.select(same.alias("v")).first() == df.select(swapped.alias("v")).first()
    assert df.select(same.alias("v")).first() != renamed.select(record_hash(renamed).alias("v")).first()
