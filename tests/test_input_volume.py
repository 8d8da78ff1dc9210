"""What the race tables and landed pages cost before a query begins."""

import os

import pytest
from pyspark.sql import functions as F

from pitwall.operators.windows import Key, numeric_slice, row_number_by
from pitwall.plans.base_tables import RaceTables
from pitwall.session import scratch_path
from pitwall.sources import conform, landed

SF = "/root/testdata/sf0.001"


def exchanges(df):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in x]


@pytest.fixture
def shuffled_joins(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sliced_ranks_deal_rows_once(spark, shuffled_joins):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id")
    ranked = row_number_by(df, ["g"], [Key("id")], "rn", slices=[numeric_slice(Key("id"), 50)])
    # rows for the window and for the counts (one exchange, reused), counts by group, offsets by slice
    assert len(exchanges(ranked)) == 4
    assert ranked.filter(F.col("rn") != F.floor(F.col("id") / 3) + 1).count() == 0 and ranked.count() == 1000


def test_laps_are_dealt_once_for_numbers_and_buckets(spark):
    store = conform.Store(spark, SF, scratch_path(spark, "volume"))
    laps = conform.RECIPES["laps"][1](spark, SF, buckets=store.buckets)
    assert sum("round" in x for x in exchanges(laps)) == 1
    plain = RaceTables(spark, SF, conformed=False).laps
    assert store.table("laps").select(*plain.columns).exceptAll(plain).count() == 0 < plain.count() == store.table("laps").count()


def test_a_query_lands_only_its_own_endpoint(spark):
    pages = landed.Landed(RaceTables(spark, SF), scratch_path(spark, "landed-one"))
    assert landed.read_pages(spark, pages["seasons"]).count() == 1
    assert os.listdir(pages.root.removeprefix("file:")) == ["seasons"]
