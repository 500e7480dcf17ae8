
from conftest import SF01
from pyspark.sql import functions as F

from tessera.functions import numbers
from tessera.operators import folds

from tessera.plans.registry import QUERIES


def test_ledger_totals_match_survey_probe(spark):
    # the fold over the events as they are (the registered query leaves some accounts and amounts out)
    events = spark.read.parquet(f"{SF01}/events.parquet")
    fold = folds.ledger(events, "user_id", ["ts", "event_id"], "event_type", numbers.to_cents(F.col("value")), ["signup"], ["purchase"])
    for totals in (fold, QUERIES["ledger_stream"](spark, SF01)):
        r = totals.selectExpr("sum(balance) b", "sum(n_rejected) r", "count(*) n").first()
        assert (r["b"], r["r"], r["n"]) == (4_290_056, 495, 150)


def test_set_operation_sizes(spark):
    assert QUERIES["intersect_distinct"](spark, SF01).count() == 199
    assert QUERIES["except_distinct"](spark, SF01).count() == 103
    assert QUERIES["double_except"](spark, SF01).count() == 199


def test_duplicate_line_keys(spark):
    d = QUERIES["dup_split"](spark, SF01)
    assert d.count() == 60_000
    assert d.select("l_orderkey", "line_no").distinct().count() == 45_832
