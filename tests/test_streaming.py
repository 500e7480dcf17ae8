import os
import random
import statistics

import pyarrow as pa
import pyarrow.parquet as papq
from conftest import SF001, rows
from pyspark.sql import functions as F

from tessera import streaming as stream
from tessera.operators import folds
from tessera.plans.registry import EVENTS_SCHEMA


def _split_events(spark, scratch, parts=4):
    """The events table as several files, so the stream has several micro-batches
    that arrive in time order."""
    e = spark.read.parquet(f"{SF001}/events.parquet")
    bounds = e.selectExpr("min(ts) lo", "max(ts) hi").first()
    span = (bounds["hi"] - bounds["lo"]) / parts
    folder = os.path.join(scratch, "events")
    for i in range(parts):
        lo = bounds["lo"] + span * i
        hi = bounds["lo"] + span * (i + 1)
        part = e.where((F.col("ts") >= lo) & ((F.col("ts") < hi) if i < parts - 1 else F.lit(True)))
        part.coalesce(1).write.parquet(os.path.join(folder, f"p{i}"))
    files = []
    for i in range(parts):
        d = os.path.join(folder, f"p{i}")
        for f in sorted(os.listdir(d)):
            if f.endswith(".parquet"):
                target = os.path.join(folder, f"batch{i:02d}.parquet")
                os.link(os.path.join(d, f), target)
                files.append(target)
    return folder, e


def test_stream_counts_equal_batch(spark):
    out = stream.stream_counts(spark, SF001, EVENTS_SCHEMA, "event_type", glob="events.parquet")
    batch = spark.read.parquet(f"{SF001}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"))
    assert rows(out) == rows(batch)


def test_stream_ledger_equals_batch_fold_over_micro_batches(spark, scratch):
    folder, e = _split_events(spark, scratch)
    out = stream.stream_ledger(spark, folder, EVENTS_SCHEMA, "user_id", ["ts", "event_id"], "event_type",
                               "round(value * 100)", ["signup"], ["purchase"], glob="batch*.parquet")
    batch = folds.ledger(e, "user_id", ["ts", "event_id"], "event_type", F.round(F.col("value") * 100),
                         ["signup"], ["purchase"])
    assert rows(out.drop("n_late")) == rows(batch)


def test_ledger_state_keeps_micro_batches_flat(spark, scratch):
    """36 micro-batches: each touches only the accounts that occur in it, so
    late ones take no longer than early ones; late events, ties and the NULL account included."""
    import datetime as dt

    schema = "acct string, ts timestamp_ntz, id long, kind string, amount long"
    t0, rnd, events, late = dt.datetime(2024, 1, 1), random.Random(3), [], []
    os.makedirs(f"{scratch}/in")
    for b in range(36):
        batch = []
        for k in range(5):
            acct = None if k == 0 else "hot" if k < 3 else f"a{rnd.randrange(40)}"
            batch.append((acct, t0 + dt.timedelta(microseconds=b * 7), 10 * b + k, "in" if rnd.random() < 0.5 else "out", rnd.choice([None, -1, 3, 50])))
        events += batch
        if b == 30:
            late = [("hot", t0, 1, "in", 10**9), (None, None, 2, "in", None)]
            batch = batch + late
        pq = f"{scratch}/in/{b:03d}.parquet"
        papq.write_table(pa.Table.from_pylist([dict(zip(("acct", "ts", "id", "kind", "amount"), r, strict=True)) for r in batch], pa.schema(
            [("acct", pa.string()), ("ts", pa.timestamp("us")), ("id", pa.int64()), ("kind", pa.string()), ("amount", pa.int64())])), pq)
        os.utime(pq, (1_700_000_000 + b,) * 2)
    out = stream.stream_ledger(spark, f"{scratch}/in", schema, "acct", ["ts", "id"], "kind", "amount", ["in"], ["out"], files_per_trigger=1)
    want = folds.ledger(spark.createDataFrame(events, schema), "acct", ["ts", "id"], "kind", F.col("amount"), ["in"], ["out"])
    assert rows(out.drop("n_late")) == rows(want)
    assert {r["acct"]: r["n_late"] for r in out.collect() if r["n_late"]} == {"hot": 1, None: 1}
    assert {tuple(r) for r in out.late_events.collect()} == set(late)
    took = [p["durationMs"]["triggerExecution"] for p in out.progress if p["numInputRows"]]
    assert statistics.median(took[-10:]) < 2 * statistics.median(took[2:12])
