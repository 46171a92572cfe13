"""What may not grow with the tables: tasks per file, work done again, bytes of the input made."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.operators import catalog, contracts
from tillflow.operators.upsert import merge_upsert
from tillflow.plans import derive, queries
from tillflow.plans.queries import QUERIES
from tillflow.sources.streams import by_header
from tillflow.streaming import sinks


def test_lines_of_a_file_are_not_one_tasks(spark, capsys):
    lines = spark.range(0, 1000, 1, 8).select(
        F.when(F.col("id") == 0, "customer_id").otherwise(F.col("id").cast("string")).alias("value"),
        F.expr("concat(id div 1000, '.csv')").alias("file_path"),
        F.when(F.col("id") < 125, 0).otherwise(F.col("id")).alias("block_start"),
    )
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = by_header(lines)
        held = rows.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(held) == 8 and sum(r["count"] for r in held) == 999


def test_codes_are_as_the_formatter_makes_them(spark):
    numbers = [None, -10**7, -12, -1, 0, 7, 99999, 100000, 10**12]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    found = df.select(
        derive._code("C-", "n", 5).alias("a"), F.format_string("C-%05d", "n").alias("b")
    ).collect()
    assert all(r["a"] == r["b"] for r in found), found


def reads_of(df, table):
    """How often the plan of ``df`` reads a given table."""
    return df._jdf.queryExecution().executedPlan().toString().count(f"/{table}.parquet")


def test_an_upsert_derives_its_sides_once(spark, small_dir):
    assert reads_of(QUERIES["pos_merge"](spark, small_dir), "lineitem") == 0


def test_sides_of_an_upsert_are_typed_judged_and_ranked_once(spark, small_dir, monkeypatch):
    store, plans = queries._stored, []

    def noted(rows, name):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return store(rows, name)

    monkeypatch.setattr(queries, "_stored", noted)
    assert QUERIES["pos_merge_line_key"](spark, small_dir).count() > 0
    (plan,) = plans
    assert plan.count("- Window [") == 1
    assert "Generate" not in plan
    assert plan.count("try_cast(event_time") == 1


def test_amounts_and_arrivals_are_as_by_decimals_and_intervals(spark):
    numbers = [None, -10**7, -536, -535, -101, -100, -99, -1, 0, 1, 7, 535, 10**7, 10**12]
    cents = "100 + n * 37 % 19800"
    df = spark.createDataFrame([(n, n and n % 5000) for n in numbers], "n long, s long").crossJoin(
        spark.sql("select explode(array(timestamp_ntz'1969-12-31 23:59:59.5', timestamp_ntz'2024-02-29', null)) as t")
    )
    found = df.select(
        derive._price(cents).alias("a"),
        F.expr(f"cast(cast(({cents}) / 100 as decimal(10,2)) as string)").alias("b"),
        derive._after("t", F.col("s")).alias("c"),
        F.expr("cast(t + make_dt_interval(0, 0, 0, s) as timestamp)").alias("d"),
    ).collect()
    assert len(found) == 3 * len(numbers)
    assert all(r["a"] == r["b"] and r["c"] == r["d"] for r in found), found


def test_a_table_is_filled_from_rows_derived_once(spark, small_dir, monkeypatch):
    fill, seen = catalog.fill_table, []

    def noted(df, *args):
        seen.append(reads_of(df, "lineitem"))
        fill(df, *args)

    monkeypatch.setattr(catalog, "fill_table", noted)
    assert QUERIES["pos_catalog"](spark, small_dir).count() > 0
    assert seen == [0, 0, 0]


def test_payload_files_are_a_fraction_of_the_payloads(spark, small_dir):
    config = queries._payload_job(spark, small_dir)
    text = spark.read.text(config.payload_options["path"])
    made = text.agg(F.count("*"), F.sum(F.length("value"))).first()
    files = text.select("_metadata.file_path", "_metadata.file_size").distinct()
    written = files.agg(F.sum("file_size")).first()[0]
    assert made[0] == derive.table(spark, small_dir, "lineitem").count()
    assert written * 4 < made[1]


def test_a_first_batch_is_joined_with_nothing(spark, tmp_path):
    joined = []
    contract = contracts.Contract("first", T.StructType([T.StructField("k", T.StringType())]), False, "silver")
    held = sinks.KeyedTable(str(tmp_path / "first"), contract, ("k",), 4)

    def combine(current, batch):
        joined.append(current is not None)
        return merge_upsert(current, batch, ["k"])

    for batch_id, keys in enumerate((["a", "a", "b"], ["b", "c"])):
        df = spark.createDataFrame([(k,) for k in keys], "k string")
        sinks.write_keyed(df, held, batch_id, combine, "s")
    assert joined == [False, True]
    assert sorted(r["k"] for r in sinks.read_keyed(spark, held).collect()) == ["a", "a", "b", "c"]


def test_buckets_grow_with_the_files(spark, small_dir, monkeypatch):
    lines = derive.table(spark, small_dir, "lineitem")
    assert queries._buckets(lines) == queries.QUERY_BUCKETS
    monkeypatch.setattr(queries, "BYTES_OF_BUCKET", 1 << 12)
    assert queries._buckets(lines) > queries.QUERY_BUCKETS
