"""Streams: restarts, repeated batches, malformed files, growing schemas."""

from __future__ import annotations

import json
from collections import Counter
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from tests.test_rules import GOOD, PROFILE
from tillflow.operators import contracts as c
from tillflow.sources.schemas import CUSTOMER_FIELDS, CUSTOMER_RAW, POS_BRONZE
from tillflow.streaming import customer_job, pos_job, sinks

AS_OF = "2026-01-01 00:00:00"


def payload(n: int, **change) -> str:
    return json.dumps({**GOOD, "transaction_id": f"TXN-{n}", **change})


@pytest.fixture
def pos(tmp_path):
    (tmp_path / "in").mkdir()
    config = pos_job.PosConfig(
        str(tmp_path / "out"),
        "text",
        {"path": str(tmp_path / "in")},
        trigger=pos_job.DRAIN,
        as_of="2025-07-01 10:30:00",
        buckets=4,
    )

    def put(name: str, *lines: str) -> None:
        (tmp_path / "in" / name).write_text("\n".join(lines))

    return config, put


def clean_of(spark, config):
    df = sinks.read_keyed(spark, config.clean_table())
    return Counter((r["transaction_id"], str(r["item_quantity"])) for r in df.collect())


def test_runs_go_on_where_the_last_one_ended(spark, pos):
    config, put = pos
    put("a.txt", payload(1), payload(2, sku="bad"), payload(3, event_time="2025-07-01T08:00:00Z"))
    pos_job.run_pos(spark, config)
    assert clean_of(spark, config) == {("TXN-1", "2.00"): 1}
    put("b.txt", payload(1, item_quantity=9), payload(4), payload(4), "no json")
    pos_job.run_pos(spark, config)
    pos_job.run_pos(spark, config)
    # Known ids are replaced, unknown ones are added, repeated or not.
    assert clean_of(spark, config) == {("TXN-1", "9.00"): 1, ("TXN-4", "2.00"): 2}
    bad = sinks.read_appended(spark, config.path("quarantined"), c.POS_QUARANTINED.schema)
    assert Counter(len(r["error_reason"]) for r in bad.collect()) == {1: 1, 14: 1}
    late = sinks.read_appended(spark, config.path("late"), c.POS_LATE_ARRIVALS.schema)
    assert [r["transaction_id"] for r in late.collect()] == ["TXN-3"]
    bronze = spark.read.schema(POS_BRONZE).parquet(config.path("bronze"))
    assert bronze.count() == 7


def lines_of(spark, numbers, stamp="2025-07-01 10:00:10", **change):
    rows = [{**GOOD, "transaction_id": f"T{i:04d}", **change} for i in numbers]
    return spark.createDataFrame(rows, c.s.POS_PAYLOAD).withColumn(
        "ingested_time", F.lit(stamp).cast("timestamp")
    )


def test_a_repeated_batch_changes_nothing(spark, pos):
    config, _ = pos
    batch = lines_of(spark, range(9))
    bad_sku = F.when(F.substring("transaction_id", 2, 4).cast("int") % 3 == 0, "x").otherwise(F.col("sku"))
    batch = batch.withColumn("sku", bad_sku)
    # Copies in one batch: the second time they would be two rows for a known key.
    batch = batch.union(batch.filter("transaction_id = 'T0001'"))
    assert pos_job.route_batch(batch, 0, config, "s") == {"quarantine": 3, "clean": 7}
    once = clean_of(spark, config)
    assert pos_job.route_batch(batch, 0, config, "s") == {"quarantine": 3, "clean": 7}
    assert clean_of(spark, config) == once and sum(once.values()) == 7
    bad = sinks.read_appended(spark, config.path("quarantined"), c.POS_QUARANTINED.schema)
    assert bad.count() == 3


def test_an_empty_batch(spark, pos):
    config, _ = pos
    assert pos_job.route_batch(lines_of(spark, range(1)).limit(0), 0, config, "s") == {}
    assert clean_of(spark, config) == {}


def test_a_new_checkpoint_adds_to_old_tables(spark, pos):
    config, put = pos
    put("a.txt", *[payload(i) for i in range(5)], payload(8, sku="bad"), payload(9, sku="bad"))
    pos_job.run_pos(spark, config)
    # Another job with checkpoints of its own: its batches begin with 0 again.
    other = config._replace(
        checkpoints="again", payload_options={"path": config.payload_options["path"] + "2"}
    )
    folder = Path(other.payload_options["path"])
    folder.mkdir()
    (folder / "b.txt").write_text("\n".join([payload(4, item_quantity=7), payload(5), payload(6, sku="bad")]))
    pos_job.run_pos(spark, other._replace(bronze="bronze2"))
    found = clean_of(spark, config)
    assert found == {**{(f"TXN-{i}", "2.00"): 1 for i in (0, 1, 2, 3, 5)}, ("TXN-4", "7.00"): 1}
    bad = sinks.read_appended(spark, config.path("quarantined"), c.POS_QUARANTINED.schema)
    assert bad.count() == 3


def test_an_upsert_leaves_other_slots_alone(spark, pos):
    config, _ = pos
    config = config._replace(slot="substring(transaction_id, 1, 3)", buckets=2)
    pos_job.route_batch(lines_of(spark, range(300)), 0, config, "s")

    def files():
        found = Path(config.path("cleaned")).glob("_slot=*/*.parquet")
        return {str(p): p.stat().st_mtime_ns for p in found}

    before = files()
    assert len({Path(p).parent for p in before}) == 3
    pos_job.route_batch(lines_of(spark, range(295, 305), item_quantity="9"), 1, config, "s")
    same = {p for p, at in files().items() if before.get(p) == at}
    assert {Path(p).parent.name for p in same} == {"_slot=sT00", "_slot=sT01"}
    found = clean_of(spark, config)
    assert len(found) == 305 and found["T0295", "9.00"] == found["T0294", "2.00"] == 1
    # The definition is gone with the session; the folders are not.
    spark.sql(f"DROP TABLE {config.clean_table().name}")
    assert clean_of(spark, config) == found


def above(tree: list[str], at: int) -> list[str]:
    """The operators over a line of a plan."""
    depth = [len(x) - len(x.lstrip(" :+-")) for x in tree]
    found, least = [], depth[at]
    for i in reversed(range(at)):
        if depth[i] < least:
            found.append(tree[i])
            least = depth[i]
    return found


def test_an_upsert_does_not_shuffle_its_target(spark, pos, capsys):
    config, _ = pos
    table = config.clean_table()
    pos_job.route_batch(lines_of(spark, range(50)), 0, config, "s")
    target = sinks.read_keyed(spark, table)
    source = spark.createDataFrame(target.limit(10).collect(), target.schema)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sinks.merge_upsert(target, source, table.keys).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    tree = capsys.readouterr().out.split("\n\n")[0].splitlines()
    scans = [above(tree, i) for i, x in enumerate(tree) if "Scan parquet" in x]
    assert len(scans) == 2 and not any("Exchange" in x for path in scans for x in path), tree
    assert any("FullOuter" in x for x in scans[0])


def test_two_lines_of_a_known_transaction_end_the_batch(spark, pos):
    config, put = pos
    put("a.txt", payload(1))
    pos_job.run_pos(spark, config)
    put("b.txt", payload(1), payload(1, item_sequence=2))
    with pytest.raises(Exception, match="several source rows"):
        pos_job.run_pos(spark, config)


def test_lines_of_a_transaction_by_the_longer_key(spark, pos):
    config, put = pos
    config = config._replace(keys=("transaction_id", "item_sequence"))
    put("a.txt", payload(1))
    pos_job.run_pos(spark, config)
    put("b.txt", payload(1, item_quantity=3), payload(1, item_sequence=2))
    pos_job.run_pos(spark, config)
    assert clean_of(spark, config) == {("TXN-1", "3.00"): 1, ("TXN-1", "2.00"): 1}


def test_an_interval_is_supervised(spark, pos):
    config, put = pos
    put("a.txt", payload(1), payload(1, item_sequence=2))
    pos_job.run_pos(spark, config)
    put("b.txt", payload(1), payload(1))
    with pytest.raises(Exception, match="several source rows"):
        pos_job.run_pos(spark, config._replace(trigger="1 second"))
    assert not spark.streams.active


def test_tables_grow_by_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    contract = c.Contract("t", c.StructType([c.s.T.StructField("a", c.s.T.LongType(), False)]), True, "bronze")
    assert sinks.read_appended(spark, path, contract.schema).count() == 0
    sinks.append_batch(spark.range(2).withColumnRenamed("id", "a"), path, 0, contract)
    sinks.append_batch(spark.range(1).selectExpr("id as a", "'x' as more"), path, 1, contract)
    found = sinks.read_appended(spark, path, contract.schema)
    assert Counter(map(tuple, found.select("a", "more").collect())) == {
        (0, None): 1, (1, None): 1, (0, "x"): 1
    }


HEADER = ",".join(CUSTOMER_FIELDS)


def line(**change) -> str:
    return ",".join({**PROFILE, **change}[name] for name in CUSTOMER_FIELDS)


def raw_rows(spark, tmp_path, files: dict[str, list[str]], **options):
    """What the bronze job makes of some files, by their ids and what was rescued."""
    folder = tmp_path / "files"
    folder.mkdir()
    for name, lines in files.items():
        (folder / name).write_text("\n".join(lines))
    config = customer_job.CustomerConfig(str(folder), str(tmp_path / "out"), AS_OF, 4)
    customer_job.run_bronze(spark, config)
    found = sinks.read_appended(spark, config.path("raw"), CUSTOMER_RAW)
    assert found.schema.names == CUSTOMER_RAW.names
    rows = {}
    for r in found.collect():
        rescued = r["_rescued_data"]
        other = json.loads(rescued) if rescued else {}
        if rescued:
            assert other.pop("_file_path").startswith("file:")
        rows[r["customer_id"], r["zip_code"], r["first_name"]] = other
    return rows, found


def test_misfit_fields_are_rescued(spark, tmp_path):
    first, last = PROFILE["first_name"], PROFILE["zip_code"]
    short = ",".join(line(customer_id="C1").split(",")[:3])
    files = {
        "a.csv": [HEADER, line(customer_id="C0"), short, "", "  ", line(customer_id="C2") + ',more,,"x, y"'],
        "b.csv": [HEADER + ",note,email", line(customer_id="C3") + ",hi,again", line(customer_id="C4") + ",,"],
        "c.csv": [HEADER],
        "d.csv": ["no,header", "C5,here"],
        "e.csv": [],
    }
    found, rows = raw_rows(spark, tmp_path, files)
    assert found == {
        ("C0", last, first): {},
        ("C1", None, first): {},
        ("C2", last, first): {"#17": "more", "#19": "x, y"},
        ("C3", last, first): {"note": "hi", "email#18": "again"},
        ("C4", last, first): {},
        (None, None, None): {"no": "C5", "header": "here"},
    }


def test_columns_are_found_by_name_in_each_file(spark, tmp_path):
    swapped = [*CUSTOMER_FIELDS[8:], *CUSTOMER_FIELDS[:8]]
    profile = {**PROFILE, "customer_id": "C1"}
    fewer = [n for n in CUSTOMER_FIELDS if n not in ("zip_code", "first_name")]
    files = {
        "a.csv": [HEADER, line(customer_id="C0")],
        "b.csv": ["\ufeff" + ", ".join(swapped), ",".join(profile[n] for n in swapped)],
        "c.csv": [",".join(fewer), ",".join({**PROFILE, "customer_id": "C2"}[n] for n in fewer)],
    }
    found, rows = raw_rows(spark, tmp_path, files)
    assert not any(found.values()) and len(found) == 3
    assert ("C2", None, None) in found
    tables = {r["customer_id"]: r.asDict() for r in rows.collect()}
    for name in CUSTOMER_FIELDS[1:]:
        assert tables["C1"][name] == tables["C0"][name] == PROFILE[name]


def test_a_file_in_many_blocks_has_one_header(spark, tmp_path):
    lines = [HEADER, *[line(customer_id=f"C{i}", zip_code=str(i)) for i in range(400)]]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found, _ = raw_rows(spark, tmp_path, {"a.csv": lines, "b.csv": lines[:1] + lines[-1:]})
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == 400 and not any(found.values())


def test_customers_over_several_runs(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    root = str(tmp_path / "out")
    for day, tier in enumerate(["Silver", "Gold"], 1):
        other = line(customer_id="CUST-00002", gender="X")
        (folder / f"{day}.csv").write_text("\n".join([HEADER, line(loyalty_tier=tier), other]))
        config = customer_job.CustomerConfig(str(folder), root, f"2026-01-0{day} 00:00:00", 4)
        customer_job.run_customers(spark, config)
        customer_job.run_customers(spark, config)
    current = sinks.read_keyed(spark, config.current_table()).collect()
    assert [(r["customer_id"], r["loyalty_tier"]) for r in current] == [("CUST-00001", "Gold")]
    history = sinks.read_keyed(spark, config.history_table())
    found = history.orderBy("valid_from").collect()
    assert [(r["loyalty_tier"], r["valid_to"] is None) for r in found] == [("Silver", False), ("Gold", True)]
    assert found[0]["valid_to"] == found[1]["valid_from"]
    dead = sinks.read_appended(spark, f"{root}/dead_letters", customer_job.DEAD_LETTERS.schema)
    assert dead.count() == 2 and dead.first()["is_corrupted"]
