"""Screening behind a Bloom filter equals plain screening; the filter clears nearly all that isn't listed."""

import random

import pytest
from pyspark.sql import functions as F

from txnwatch.operators.bloom import probable_hits, screen_large
from txnwatch.operators.screening import screen


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def tables(spark):
    draw = random.Random(7)
    keys = [None, "", "hot"] + [f"U{i}" for i in range(3000)]
    txns = spark.createDataFrame([(i, "hot" if i % 3 == 0 else draw.choice(keys)) for i in range(9000)], "id int, user_id string")
    listed = spark.createDataFrame([(k,) for k in [None, "", "hot", "hot", "elsewhere"] + [f"U{i}" for i in range(0, 3000, 17)]], "listed string")
    return txns.cache(), listed


@pytest.mark.parametrize("keep", ["hits", "pass"])
@pytest.mark.parametrize("max_blocks", [1, 1 << 18])
def test_equals_plain_screening(tables, keep, max_blocks):
    txns, listed = tables
    got = screen_large(txns, listed, "user_id", keep, "listed", max_blocks)
    assert got.columns == txns.columns
    assert _rows(got) == _rows(screen(txns, listed, "user_id", keep, "listed").select(*txns.columns))


def test_filter_keeps_every_hit_and_little_else(tables):
    txns, listed = tables
    hits = {r.id for r in screen(txns, listed, "user_id", "hits", "listed").collect()}
    probable = {r.id for r in probable_hits(txns, listed, "user_id", "listed").collect()}
    assert hits <= probable
    assert len(probable - hits) <= 0.05 * (txns.count() - len(hits))


def test_transactions_move_only_behind_the_filter(tables):
    plan = screen_large(*tables, "user_id", "hits", "listed")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
    left = plan[plan.index("SortMergeJoin"):]
    assert left.index("Exchange hashpartitioning(user_id") < left.index("BroadcastHashJoin")


def test_empty_list_and_empty_table(tables):
    txns, listed = tables
    none = listed.where("false")
    assert screen_large(txns, none, "user_id", "hits", "listed").count() == 0
    assert screen_large(txns, none, "user_id", "pass", "listed").count() == txns.count()
    assert screen_large(txns.where("false"), listed, "user_id", "pass", "listed").count() == 0


def test_keys_of_two_types_are_refused(spark, tables):
    with pytest.raises(TypeError):
        screen_large(tables[0], spark.range(3).withColumn("listed", F.col("id")), "user_id", list_key="listed")
