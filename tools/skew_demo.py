"""Hot-key check: a running sum per user when one user holds a third of all rows.

The input is derived from the given ``events`` table: every event is
repeated ``REPEAT`` times (each copy shifted by whole days so the order stays
total) and every third copy is given to user 0.  The same running sum is
computed with a plain window (the hot user is one window partition, sorted by
one task) and with the segmented scan of ``tessera.operators.windows``
(only hot users cut, into chunks of ~250,000 rows along the timestamp).  Both
results are checked equal by an order-insensitive checksum.

Wall time on a few local cores hides skew (the hot task runs beside the
others), so the tool also reads Spark's event log (written to a scratch
folder) and reports the longest single task of each run: on a cluster with
thousands of cores that task is the critical path.

    python tools/skew_demo.py [sf_dir] [repeat] [shuffle_partitions]
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import windows  # noqa: E402
from tessera.session import build_session, table  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeat = int(sys.argv[2]) if len(sys.argv) > 2 else 100
    parts = int(sys.argv[3]) if len(sys.argv) > 3 else 64
    log_dir = tempfile.mkdtemp(prefix="tessera-skew-log-")
    spark = build_session(shuffle_partitions=parts, checkpoint_dir=tempfile.mkdtemp(prefix="tessera-skew-"),
                          extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                                 "spark.sql.files.maxPartitionBytes": str(4 << 20)})
    e = table(spark, sf, "events").select("event_id", "ts", "user_id", "value")
    big = (e.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(repeat - 1))))
           .select((F.col("event_id") * repeat + F.col("copy")).alias("event_id"),
                   (F.col("ts") + F.make_dt_interval(F.col("copy").cast("int") * 31)).alias("ts"),
                   F.when(F.col("copy") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("user_id"),
                   "value"))
    # written once, so both versions start from a Parquet scan as real data would
    from tessera.session import checkpoint_dir
    path = f"{checkpoint_dir(spark).rstrip('/')}/skew-demo-{os.getpid()}"
    big.repartition(parts).write.mode("overwrite").parquet(path)
    big = spark.read.parquet(path)
    order = ["ts", "event_id"]
    cents = F.round(F.col("value") * 100).cast("bigint")
    plain = windows.running_sums(big, ["user_id"], order, {"rs": cents})
    seg = windows.running_sums(big, ["user_id"], order, {"rs": cents},
                               segments=windows.Segments(chunk_rows=250_000))

    tracker = spark.sparkContext.statusTracker()
    stages_of: dict[str, set] = {}

    def run(df, name):
        before = set(tracker.getJobIdsForGroup(None))
        t0 = time.perf_counter()
        r = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("event_id", "rs")).alias("h")).first()
        elapsed = time.perf_counter() - t0
        jobs = set(tracker.getJobIdsForGroup(None)) - before
        stages_of[name] = {sid for j in jobs for sid in (tracker.getJobInfo(j).stageIds if tracker.getJobInfo(j)
                                                           else [])}
        return elapsed, (r["n"], r["h"])

    run(seg, "warmup")
    t_plain, c_plain = run(plain, "plain")
    t_seg, c_seg = run(seg, "segmented")
    hot = big.where(F.col("user_id") == 0).count()

    # first-row flags per (user, event type): the aggregate side has one row
    # per group; joined back with a sort-merge join, the hot user's groups
    # make skewed partitions that AQE's skew join splits
    typed = big.withColumn("event_type", F.element_at(F.array(*[F.lit(t) for t in "abcde"]),
                                                       (F.col("event_id") % 5 + 1).cast("int")))
    flags = windows.repeat_flags(typed, ["user_id"], "event_type", order).withColumn(
        "rs", F.col("repeated").cast("bigint"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(8 << 20))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(8 << 20))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    t_noskew, c_noskew = run(flags, "join_no_skew_handling")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    t_skew, c_skew = run(flags, "join_aqe_skew_join")
    spark.stop()
    longest = _longest_tasks(log_dir, stages_of)
    print(f"rows={c_plain[0]} hot_user_rows={hot} shuffle_partitions={parts}")
    print(f"running sum: plain_window={t_plain:.1f}s (longest task {longest.get('plain', 0):.1f}s) "
          f"segmented={t_seg:.1f}s (longest task {longest.get('segmented', 0):.1f}s) equal={c_plain == c_seg}")
    print(f"repeat flags join-back: no_skew_handling={t_noskew:.1f}s "
          f"(longest task {longest.get('join_no_skew_handling', 0):.1f}s) "
          f"aqe_skew_join={t_skew:.1f}s (longest task {longest.get('join_aqe_skew_join', 0):.1f}s) "
          f"equal={c_noskew == c_skew}")


def _longest_tasks(log_dir: str, stages_of: dict) -> dict:
    """Longest task duration (s) of each run, from the event log."""
    import glob
    import json

    import zstandard
    run_of = {sid: name for name, sids in stages_of.items() for sid in sids}
    longest: dict[str, float] = {}
    for path in glob.glob(os.path.join(log_dir, "**", "events_*"), recursive=True):
        with open(path, "rb") as f:
            if path.endswith(".zstd"):
                with zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True) as r:
                    raw = r.read()
            else:
                raw = f.read()
        for line in raw.decode("utf-8").splitlines():
            if '"SparkListenerTaskEnd"' not in line:
                continue
            ev = json.loads(line)
            name = run_of.get(ev["Stage ID"])
            if name:
                info = ev["Task Info"]
                longest[name] = max(longest.get(name, 0.0), (info["Finish Time"] - info["Launch Time"]) / 1000)
    return longest


if __name__ == "__main__":
    main()
