"""Streams that fail in the middle of a batch, that stop, and what they count."""

from __future__ import annotations

import threading
import time
from collections import Counter
from pathlib import Path

import pytest

from pyspark.sql import functions as F

from tests.test_rules import PROFILE
from tests.test_streams import clean_of, payload, pos  # noqa: F401
from tillflow.operators import contracts as c
from tillflow.operators.customers import flag_customers
from tillflow.sources.schemas import CUSTOMER_FLAGGED, CUSTOMER_RAW, POS_BRONZE
from tillflow.sources.streams import read_table_stream
from tillflow.streaming import expectation_log, pos_job, sinks, supervisor


def until(told, seconds=60):
    ends = time.monotonic() + seconds
    while not told():
        assert time.monotonic() < ends
        time.sleep(0.1)


def in_background(watched):
    errors = []

    def run():
        try:
            watched.run()
        except Exception as error:
            errors.append(error)

    thread = threading.Thread(target=run)
    thread.start()
    return thread, errors


def test_a_query_killed_in_mid_batch(spark, pos, monkeypatch):  # noqa: F811
    config, put = pos
    config = config._replace(trigger="200 milliseconds")
    # Copies of a new key: a batch that is repeated as another one would fail.
    put("a.txt", payload(1), payload(2), payload(2), payload(3, sku="bad"))
    upsert, killed = pos_job.upsert_sink, []

    def dying(df, table, batch_id, stream=None):
        # Once before the last write of a batch, once after it.
        if len(killed) == 0:
            killed.append("before")
            raise RuntimeError("killed")
        upsert(df, table, batch_id, stream)
        if len(killed) == 1:
            killed.append("after")
            raise RuntimeError("killed")

    monkeypatch.setattr(pos_job, "upsert_sink", dying)
    watched = pos_job.supervised(spark, config, retries=2)
    watched.pause = 0.1
    thread, errors = in_background(watched)
    try:
        until(lambda: len(watched.queries) == 2)
        bronze = watched.queries["bronze"].runId
        until(lambda: watched.restarts["silver"] == 2)
        put("b.txt", payload(1, item_quantity=5), payload(4))
        until(lambda: clean_of(spark, config).get(("TXN-4", "2.00")))
        assert watched.queries["bronze"].runId == bronze
    finally:
        watched.stop()
        thread.join(60)
    assert not errors and not spark.streams.active and killed == ["before", "after"]
    assert clean_of(spark, config) == {
        ("TXN-1", "5.00"): 1, ("TXN-2", "2.00"): 2, ("TXN-4", "2.00"): 1
    }
    bad = sinks.read_appended(spark, config.path("quarantined"), c.POS_QUARANTINED.schema)
    assert bad.count() == 1
    assert spark.read.schema(POS_BRONZE).parquet(config.path("bronze")).count() == 6


def test_too_many_failures_end_both(spark, pos, monkeypatch):  # noqa: F811
    config, put = pos
    put("a.txt", payload(1))

    def dying(*_):
        raise RuntimeError("killed each time")

    monkeypatch.setattr(pos_job, "upsert_sink", dying)
    watched = pos_job.supervised(spark, config._replace(trigger="200 milliseconds"), retries=1)
    watched.pause = 0.1
    with pytest.raises(Exception, match="killed each time"):
        watched.run()
    assert watched.restarts == {"bronze": 0, "silver": 1}
    assert not spark.streams.active


def test_a_stop_waits_for_the_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("1\n2")
    began, finished = threading.Event(), []

    def slow(batch, batch_id):
        began.set()
        time.sleep(1.5)
        finished.append((batch_id, batch.count()))

    def start():
        lines = spark.readStream.text(str(tmp_path / "in"))
        writer = lines.writeStream.foreachBatch(slow).trigger(processingTime="100 milliseconds")
        return writer.option("checkpointLocation", str(tmp_path / "checkpoint")).start()

    watched = supervisor.Supervisor(spark, {"only": start})
    thread, errors = in_background(watched)
    assert began.wait(30)
    watched.stop()
    thread.join(60)
    assert finished == [(0, 2)] and not errors
    commits = {p.name for p in (tmp_path / "checkpoint" / "commits").iterdir() if p.name.isdigit()}
    assert commits == {"0"}


def test_violations_are_logged_by_batch(spark, tmp_path):
    root = str(tmp_path)

    def arrive(*profiles):
        rows = [{**PROFILE, "ingestion_time": None, "_rescued_data": None, **p} for p in profiles]
        raw = spark.createDataFrame([tuple(r[n] for n in CUSTOMER_RAW.names) for r in rows], CUSTOMER_RAW)
        flag_customers(raw, "2026-01-01 00:00:00").write.mode("append").parquet(f"{root}/flagged")
        stream = read_table_stream(spark, f"{root}/flagged", CUSTOMER_FLAGGED)
        expectation_log.run_guarded(
            spark, stream, f"{root}/cleaned", f"{root}/checkpoint", f"{root}/log", "2026-01-01 00:00:00"
        )

    arrive({}, {"first_name": " "}, {"birth_date": "1800-01-01"}, {"gender": "X"})
    arrive({"last_name": ""}, {})
    log = expectation_log.expectation_log(spark, f"{root}/log")
    found = Counter(tuple(r)[1:] for r in log.collect())
    assert found == Counter(
        {
            (0, "valid_id", 3, 0): 1, (0, "completed_profile", 3, 1): 1,
            (0, "realistic_age", 3, 1): 1, (0, "no_upstream_failures", 3, 0): 1,
            (1, "valid_id", 2, 0): 1, (1, "completed_profile", 2, 1): 1,
            (1, "realistic_age", 2, 0): 1, (1, "no_upstream_failures", 2, 0): 1,
        }
    )
    assert spark.read.parquet(f"{root}/cleaned").count() == 2
    assert len(list(Path(f"{root}/log").glob("stream=*"))) == 1
    assert log.agg(F.countDistinct("query_id")).first()[0] == 1
