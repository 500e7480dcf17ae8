"""Structured Streaming form of the ledger fold.

An ``availableNow`` query over a file source keeps one row of state per account
in Spark's own keyed state (``transformWithState`` on RocksDB, below the session's
checkpoint folder).  A micro-batch reads and writes the state of the accounts
that occur in it and nothing else, so its time does not grow with the number of batches before.

Events must arrive in order.  One that comes before the last event applied to
its account cannot be applied any more: it goes to a table of late events
and is counted in ``n_late``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tessera.operators.folds import TOTALS, walk_batch
from tessera.operators.ordering import whole_number
from tessera.operators.windows import _non_null_keys
from tessera.streaming._common import file_stream, run_dir

_COUNTS = [c for c in TOTALS if c != "balance"] + ["n_late"]
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_LOWEST = -(2**63)  # stands for a NULL order value, which comes first


class _Account(StatefulProcessor):
    """Totals of one account, and the order values of the last event applied to it."""

    def __init__(self, n_order: int):
        self.n_order = n_order

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ["balance", *_COUNTS, *[f"last{k}" for k in range(self.n_order)]]
        self.state = handle.getValueState("totals", ", ".join(f"{c} bigint" for c in fields))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n = self.n_order
        parts = [p for p in rows if len(p)]
        frame = parts[0] if len(parts) == 1 else pd.concat(parts, ignore_index=True)
        frame = frame.set_axis(["_account", "_none", *[f"_o{k}" for k in range(n)], "_kind", "_w", "_amt", "_has", "_ok"], axis=1)  # they come by position
        places = [frame[f"_o{k}"].to_numpy(np.int64) for k in range(n)]
        by = np.lexsort(places[::-1])
        places = [p[by] for p in places]
        late = np.zeros(len(by), bool)
        totals, last = [0] * (1 + len(_COUNTS)), None
        if self.state.exists():
            held = [int(v) for v in self.state.get()]
            totals, last = held[:-n], held[-n:]
            tie = np.ones(len(by), bool)  # equal to the last one up to here
            for place, value in zip(places, last, strict=True):
                late |= tie & (place < value)
                tie &= place == value
            late |= tie
        keep = ~late
        if keep.any():
            amount, is_w, valid = (frame[c].to_numpy()[by][keep] for c in ("_amt", "_w", "_ok"))
            amount, is_w, valid = amount.astype(np.int64), is_w.astype(bool), valid.astype(bool)
            accepted, after = walk_batch(np.zeros(1, np.int64), amount, is_w, valid, np.array(totals[:1]))
            sums = [accepted & ~is_w, accepted & is_w, ~accepted, np.where(accepted, 0, np.abs(amount))]
            totals = [int(after[-1]), *[t + int(s.sum()) for t, s in zip(totals[1:], sums, strict=False)], totals[-1]]
            last = [int(p[keep][-1]) for p in places]
        totals[-1] += int(late.sum())
        # the first batch of an account has no late events, so there is a last one
        self.state.update((*totals, *last))
        yield self._row(key, totals)
        if late.any():
            gone = frame.iloc[by[late]]
            out = self._row(key, [None] * len(totals), len(gone))
            out["_late"] = True
            for c in [f"_o{k}" for k in range(n)] + ["_kind"]:
                out[c] = gone[c].to_numpy()
            out["_amt"] = gone["_amt"].where(gone["_has"], None).astype("Int64").to_numpy(dtype=object, na_value=None)
            yield out

    def _row(self, key, totals: list, n: int = 1) -> pd.DataFrame:
        values = [*key, *totals, False, *[None] * (self.n_order + 2)]
        names = ["_account", "_none", "balance", *_COUNTS, "_late", *[f"_o{k}" for k in range(self.n_order)], "_kind", "_amt"]
        return pd.DataFrame({c: pd.Series([v] * n, dtype=object) for c, v in zip(names, values, strict=True)})

    def close(self) -> None:
        pass


def _back(value: Column, kind: T.DataType) -> Column:
    """A column of type ``kind`` from its whole number."""
    value = F.when(value != _LOWEST, value)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        seconds = value.cast("decimal(24,6)") / F.lit(1_000_000).cast("decimal(7,0)")
        return F.expr("timestamp_ntz '1970-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(value.cast("int"))
    return value.cast(kind)


def stream_ledger(spark: SparkSession, source: str, schema: str, account: str, order: Sequence[str],
                  kind: str, amount_cents_expr: str, deposit_kinds: Sequence[str],
                  withdraw_kinds: Sequence[str], files_per_trigger: int | None = 1000, fmt: str = "parquet",
                  glob: str | None = None) -> DataFrame:
    """Totals per account as ``folds.ledger`` gives them, and ``n_late``.

    ``order`` is one or two whole-number, date or timestamp columns.  Within a
    micro-batch events are sorted; ``DataFrame.late_events`` of the result is the
    table of late ones.  A task holds one account's events of one micro-batch
    (about 30 bytes each; ``files_per_trigger`` bounds them).
    """
    base = run_dir(spark, "ledger")
    kinds = list(deposit_kinds) + list(withdraw_kinds)
    stream = file_stream(spark, source, schema, fmt, files_per_trigger, glob).where(F.col(kind).isin(kinds))
    amount = F.expr(amount_cents_expr).cast("bigint")
    places = [whole_number(stream, c) for c in order]
    if not 1 <= len(places) <= 2 or any(p is None for p in places):
        raise TypeError("order takes one or two whole-number, date or timestamp columns")
    late_schema = stream.select(account, *order, F.col(kind), amount.alias("_amt")).schema
    acct = stream.schema[account].dataType
    # a NULL is never equal to itself where batches are grouped by key in Python: the key is (value, is it NULL)
    plain, keys = _non_null_keys(stream.withColumn("_account", F.col(account)), ["_account"])
    events = plain.select(
        F.col(keys[0]).alias("_account"), (F.col(keys[1]) if len(keys) > 1 else F.lit(False)).alias("_none"), *[F.coalesce(p, F.lit(_LOWEST)).alias(f"_o{k}") for k, p in enumerate(places)],
        F.col(kind).alias("_kind"), F.col(kind).isin(list(withdraw_kinds)).alias("_w"), F.coalesce(amount, F.lit(0)).alias("_amt"),
        amount.isNotNull().alias("_has"), F.coalesce(amount >= 0, F.lit(False)).alias("_ok"))
    longs = ["balance", *_COUNTS]
    out_schema = T.StructType(
        [T.StructField("_account", acct), T.StructField("_none", T.BooleanType()), *[T.StructField(c, T.LongType()) for c in longs], T.StructField("_late", T.BooleanType()),
         *[T.StructField(f"_o{k}", T.LongType()) for k in range(len(places))], T.StructField("_kind", T.StringType()),
         T.StructField("_amt", T.LongType())])
    spark.createDataFrame([], out_schema).write.parquet(f"{base}/out/b=-1")
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        changes = events.groupBy("_account", "_none").transformWithStateInPandas(_Account(len(places)), out_schema, "update", "none")

        def write(batch: DataFrame, batch_id: int) -> None:  # a replayed batch replaces only its own folder
            batch.write.mode("overwrite").parquet(f"{base}/out/b={batch_id}")

        q = (changes.writeStream.outputMode("update").foreachBatch(write)
             .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, before)
    rows = spark.read.schema(T.StructType([*out_schema.fields, T.StructField("b", T.LongType())])).parquet(f"{base}/out")
    rows = rows.withColumn("_account", F.when(~F.col("_none"), F.col("_account")))
    newest = [F.max_by(c, "b").alias(c) for c in longs]  # the last row an account gave out is its state
    out = rows.where("not _late").groupBy(F.col("_account").alias(account)).agg(*newest)
    given = [F.col("_account").alias(account), *[_back(F.col(f"_o{k}"), late_schema[c].dataType).alias(c) for k, c in enumerate(order)],
             F.col("_kind").alias(kind), F.col("_amt")]
    out.late_events = rows.where("_late").select(*given)
    out.progress = q.recentProgress
    return out


# The state class runs inside Python workers; pickled by value, it needs no copy of this package there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
