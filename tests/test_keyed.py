"""Checks with an action, contracts, upserts, and change data capture."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tillflow.operators import catalog, contracts
from tillflow.operators.cdc import apply_scd1, apply_scd2
from tillflow.operators.history import scd2_patch
from tillflow.operators.expectations import Expectation, apply_expectations, expectation_counts
from tillflow.operators.upsert import merge_upsert
from tillflow.sources import schemas as s

FEW = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def rows(df):
    return Counter(map(tuple, df.collect()))


def by_join_and_by_scan(spark, tmp_path, values):
    """The same rows as the result of a join and as a scan."""
    left = spark.createDataFrame(values, "k int, v int")
    right = spark.createDataFrame([(k,) for k, _ in values], "k int").distinct()
    path = str(tmp_path / "rows")
    left.write.parquet(path)
    scan = spark.read.parquet(path)
    return [scan.join(right, "k"), scan]


def test_expectations_judge_only_what_is_chosen(spark, tmp_path):
    checks = [
        Expectation("positive", F.col("v") > 0, "fail"),
        Expectation("small", F.col("v") < 10, "drop"),
    ]
    for df in by_join_and_by_scan(spark, tmp_path, [(1, -5), (2, 3), (3, 30), (4, None)]):
        chosen = apply_expectations(df, checks, where=F.col("k").isin(2, 3))
        assert rows(chosen) == {(2, 3): 1}
        with pytest.raises(Exception, match="expectation violated: positive"):
            apply_expectations(df, checks).collect()
        with pytest.raises(Exception, match="expectation violated: positive"):
            apply_expectations(df, checks, where=F.col("k") == 4).collect()  # NULL is a violation
        counts = dict(expectation_counts(df, checks).collect())
        assert counts == {"positive": 2, "small": 2}


def test_contract_checks_only_what_arrives(spark, tmp_path):
    contract = contracts.Contract(
        "t",
        s.T.StructType([s.T.StructField("k", s.T.IntegerType()), s.T.StructField("v", s.T.IntegerType(), False)]),
        True,
        "bronze",
    )
    for i, df in enumerate(by_join_and_by_scan(spark, tmp_path, [(1, None), (2, 3)])):
        kept = df.filter(F.coalesce(F.col("v"), F.lit(0)) > 0)
        contracts.enforce_contract(kept, contract).write.parquet(str(tmp_path / f"good{i}"))
        with pytest.raises(Exception, match="NULL in a NOT NULL column, v"):
            contracts.enforce_contract(df, contract).write.parquet(str(tmp_path / f"bad{i}"))
    with pytest.raises(ValueError, match="column v is missing"):
        contracts.enforce_contract(spark.range(1).selectExpr("1 as k"), contract)
    with pytest.raises(ValueError, match="not int"):
        contracts.enforce_contract(spark.range(1).selectExpr("1 as k", "'a' as v"), contract)
    with pytest.raises(ValueError, match="append-only"):
        contracts.check_mode(contract, "overwrite")


def merged_by_force(target, source):
    known = {k for k, _ in target if k is not None}
    out = Counter()
    for k, v in target:
        new = [b for a, b in source if a == k and k is not None]
        if len(new) > 1:
            return None
        out[(k, new[0] if new else v)] += 1
    for k, v in source:
        if k is None or k not in known:
            out[(k, v)] += 1
    return out


PAIRS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 5)), st.integers(0, 9)), max_size=8)


@FEW
@given(PAIRS, PAIRS)
def test_merge(spark, target, source):
    expected = merged_by_force(target, source)
    result = merge_upsert(
        spark.createDataFrame(target, "k int, v int"),
        spark.createDataFrame(source, "k int, v int"),
        ["k"],
    )
    if expected is None:
        with pytest.raises(Exception, match="several source rows"):
            result.collect()
    else:
        assert rows(result) == expected


def test_merge_takes_the_newest_if_told(spark):
    target = spark.createDataFrame([(1, 0), (1, 1), (2, 0)], "k int, v int")
    source = spark.createDataFrame([(1, 5), (1, 7), (3, 1), (3, 1)], "k int, v int")
    found = merge_upsert(target, source, ["k"], on_ambiguous="v")
    assert rows(found) == {(1, 7): 2, (2, 0): 1, (3, 1): 2}


def test_merge_plan_counts_keys_by_hash(spark, capsys):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    merge_upsert(target, target, ["k"]).explain()
    assert "SortAggregate" not in capsys.readouterr().out


CHANGE = "k int, at long, updated_at int, v string"
CHANGES = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 3)),
        st.integers(0, 12),
        st.one_of(st.none(), st.integers(0, 2)),
        st.sampled_from(["a", "b", "c"]),
    ),
    max_size=14,
)


def greatest(changes):
    """The chosen change of each key and sequence."""
    rank = lambda c: tuple((x is not None, x or type(x)() if x is not None else 0) for x in (c[2], *c))
    best = {}
    for c in changes:
        at = (c[0], c[1])
        if at not in best or rank(c) > rank(best[at]):
            best[at] = c
    return best


def history_by_force(changes, tracked=False):
    lines = defaultdict(list)
    for (k, _), c in sorted(greatest(changes).items(), key=lambda x: x[0][1]):
        if not tracked or not lines[k] or lines[k][-1][3] != c[3]:
            lines[k].append(c)
    out = Counter()
    for line in lines.values():
        for c, after in zip(line, [*line[1:], None]):
            out[(*c, c[1], after[1] if after else None)] += 1
    return out


@FEW
@given(CHANGES, st.integers(0, 14), st.integers(1, 20))
def test_history_for_any_split_and_order(spark, changes, cut, stretch):
    options = {"keys": ["k"], "sequence_by": "at"}
    draw = random.Random(cut)
    mixed = list(changes)
    draw.shuffle(mixed)
    make = lambda part: spark.createDataFrame(part, CHANGE)
    first = apply_scd2(None, make(mixed[:cut]), **options, stretch=stretch)
    both = apply_scd2(first, make(mixed[cut:]), **options, stretch=stretch)
    assert rows(both) == history_by_force(changes)
    tracked = apply_scd2(None, make(mixed), **options, track_cols=["v"], stretch=stretch)
    assert rows(tracked) == history_by_force(changes, tracked=True)
    current = apply_scd1(apply_scd1(None, make(mixed[:cut]), **options), make(mixed[cut:]), **options)
    newest = {}
    for (k, at), c in greatest(changes).items():
        if k not in newest or at > newest[k][1]:
            newest[k] = c
    assert rows(current) == Counter(newest.values())


def test_except_columns(spark):
    changes = spark.createDataFrame([(1, 1, 1, "a")], CHANGE)
    assert apply_scd1(None, changes, ["k"], "at", except_cols=["v"]).columns == ["k", "at", "updated_at"]


def test_catalog(spark):
    contract = contracts.POS_TRANSACTIONS
    catalog.drop_table(spark, contract.name)
    catalog.create_table(spark, contract)
    catalog.create_table(spark, contract)
    row = {f.name: None for f in contract.schema} | {"transaction_id": "b"}
    df = spark.createDataFrame([row, {**row, "transaction_id": "a"}], contract.schema)
    catalog.fill_table(df, contract)
    table = spark.table(contract.name)
    assert [r["transaction_id"] for r in catalog.preview(table, 1, ["transaction_id"]).collect()] == ["a"]
    tags = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {contract.name}").collect()}
    assert tags["quality"] == "bronze" and tags["append_only"] == "true"
    catalog.replace_table(spark, contract)
    assert spark.table(contract.name).count() == 0
    catalog.drop_table(spark, contract.name)
    assert not spark.catalog.tableExists(contract.name)


def history_key(df):
    return Counter(tuple(r) for r in df.select("k", "at", "t", "v", "valid_from", "valid_to").collect())


PATCHED = dict(keys=["k"], sequence_by="at", tie_break=["t"])


@settings(FEW, max_examples=4)
@given(
    st.lists(
        st.lists(
            st.tuples(
                st.sampled_from(["a", "b", None]),
                st.one_of(st.none(), st.integers(0, 40)),
                st.integers(0, 2),
                st.integers(0, 3),
            ),
            max_size=14,
        ),
        min_size=2,
        max_size=2,
    ),
    st.sampled_from([1, 5, 100]),
)
def test_a_patched_history_is_the_whole_one(spark, batches, stretch):
    schema = "k string, at int, t int, v int"
    history = apply_scd2(None, spark.createDataFrame([], schema), stretch=stretch, **PATCHED)
    for batch in [*batches, batches[-1]]:  # the last one once more changes nothing
        changes = spark.createDataFrame(batch, schema)
        patch = scd2_patch(history, changes, stretch=stretch, **PATCHED)
        merged = merge_upsert(history, patch, ["k", "valid_from"], null_keys_match=True)
        history = spark.createDataFrame(merged.collect(), merged.schema)
    every = spark.createDataFrame([c for batch in batches for c in batch], schema)
    assert history_key(history) == history_key(apply_scd2(None, every, stretch=stretch, **PATCHED))


def test_a_patch_is_as_small_as_its_changes(spark):
    day = 24 * 3600
    versions = spark.range(20_000).selectExpr("concat('k', id % 20) as k", f"cast(id * {day} as int) as at", "0 as t", "0 as v")
    shape = dict(stretch=30 * day, **PATCHED)
    history = apply_scd2(None, versions, **shape)
    late = spark.createDataFrame([("k3", 3 * day + 5, 0, 1), ("k3", 23 * day, 0, 1), ("new", 7, 0, 1)], "k string, at int, t int, v int")
    found = scd2_patch(history, late, **shape).orderBy("k", "at").collect()
    # The version before the first, it, the one of the same time as the second, and the new key.
    assert [(r["k"], r["at"], r["v"], r["valid_to"]) for r in found] == [
        ("k3", 3 * day, 0, 3 * day + 5),
        ("k3", 3 * day + 5, 1, 23 * day),
        ("k3", 23 * day, 1, 43 * day),
        ("new", 7, 1, None),
    ]
