"""How filters interact: what each removes, in every order, by sorted posting lists.

Rows are sorted by part and row number and dealt out by range, so that a part
with a third of all rows lies in as many tasks as it needs.  A task walks its rows in id ranges;
in each it keeps, per filter, the sorted list of failing ids, and computes unions
over the sets of filters and differences against them by galloping merges.
Sizes of unions and differences add up over id ranges, so tasks send out sums only.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._common import col, hidden, ship, stored, without

WORD = r"[^\x20\x09-\x0D]+"
#: Keys that one galloping search looks for together.
RANGE = 512


def gallop(ids: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """First place in sorted ``ids`` that is not below each of the sorted ``keys``.
    Keys go in ranges; doubling steps from where the last range ended
    find a place beyond the range, and only the ids between are searched."""
    out, low = np.zeros(len(keys), np.int64), 0
    for at in range(0, len(keys), RANGE):
        part = keys[at:at + RANGE]
        high, step = low, RANGE
        while high < len(ids) and ids[high] < part[-1]:
            high, step = min(high + step, len(ids)), 2 * step
        out[at:at + RANGE] = low + np.searchsorted(ids[low:high], part)
        low = int(out[at + len(part) - 1])
    return out


def _within(ids: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places = gallop(ids, keys)
    if len(ids) == 0:
        return places, np.zeros(len(keys), bool)
    return places, ids[np.minimum(places, len(ids) - 1)] == keys


def union(lists: list[np.ndarray]) -> np.ndarray:
    """All ids of the sorted lists, once each and sorted: the shorter lists gallop through the longest."""
    lists = sorted(lists, key=len)
    out = lists.pop() if lists else np.zeros(0, np.int64)
    for keys in reversed(lists):
        places, there = _within(out, keys)
        out = np.insert(out, places[~there], keys[~there])
    return out


def difference(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return keys[~_within(ids, keys)[1]]


def common(keys: np.ndarray, ids: np.ndarray) -> int:
    """How many of ``keys`` are among ``ids``."""
    small, large = sorted((keys, ids), key=len)
    return int(_within(large, small)[1].sum())


def _steps(k: int) -> list[tuple[int, int]]:
    """(set of filters before, filter) of every step that some order has."""
    return [(seen, f) for seen in range(1 << k) for f in range(k) if not seen >> f & 1]


def block_sizes(ids: np.ndarray, bits: np.ndarray, flags: np.ndarray, k: int, n_flags: int) -> np.ndarray:
    """One row per step of ``_steps``: documents, failing, removed, unique, covered (removed by
    the step or before), shapley, and for each flag the removed ids that have it.  ``bits`` and
    ``flags`` hold a bit per filter and flag of each of the sorted ``ids``."""
    failing = [ids[bits >> f & 1 == 1] for f in range(k)]
    flagged = [ids[flags >> g & 1 == 1] for g in range(n_flags)]
    unions = [union([failing[f] for f in range(k) if seen >> f & 1]) for seen in range(1 << k)]
    steps, every = _steps(k), (1 << k) - 1
    gone = {(seen, f): difference(failing[f], unions[seen]) for seen, f in steps}
    # an order puts exactly `seen` before f in |seen|! (k - 1 - |seen|)! ways
    ways = [factorial(n) * factorial(k - 1 - n) for n in range(k)]
    shapley = [sum(ways[seen.bit_count()] * len(ids_) for (seen, g), ids_ in gone.items() if g == f) for f in range(k)]
    return np.array([[len(ids), len(failing[f]), len(gone[seen, f]), len(gone[every ^ 1 << f, f]), len(unions[seen | 1 << f]),
                      shapley[f], *[common(gone[seen, f], g) for g in flagged]] for seen, f in steps], np.int64)


def filter_audit(rows: DataFrame, part: Column, filters: Mapping[str, Column], lost: Mapping[str, Column],
                 block_rows: int = 1 << 16) -> DataFrame:
    """Per ``part``, ``filter_order`` (the filters' names in a row) and ``step`` (from 1; its filter is that
    of the order): ``kept`` after it, ``removed`` by it, ``redundant`` (fail it, removed earlier),
    ``unique_fails`` (fail it alone), a count of the removed for each flag of ``lost``, and ``shapley`` (removed by the filter,
    summed over all orders).  ``filters`` are true where a row fails, ``lost`` where its
    removal is to be counted; null is false.

    Every row counts for itself, whatever its columns (lists hold row numbers), so ids may be null or repeat; a null part is a part of
    its own; an empty table gives an empty result; each part has a row for each order and
    step, zeros included.  All orders of k filters have k! k rows a part: up to
    six filters are taken.  Memory of a task: one id range of ``block_rows`` rows.
    """
    k, spark = len(filters), rows.sparkSession
    if not 1 <= k <= 6:
        raise ValueError("one to six filters")
    ship(spark)

    def packed(columns: Mapping[str, Column]) -> Column:
        out = F.lit(0)
        for i, c in enumerate(columns.values()):
            out = out + F.when(c, 1 << i).otherwise(0)
        return out.cast("int")

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    marked = stored(rows.select(part.alias("part"), F.monotonically_increasing_id().alias("row"), packed(filters).alias("bits"),
                                packed(lost).alias("flags")), "audit-marks")
    # `row` is fixed by the stored table; (part, row) spreads a large part over ranges
    walked = marked.repartitionByRange(n, "part", "row").sortWithinPartitions("part", "row")
    steps, n_flags = _steps(k), len(lost)
    sums = ["docs", "failing", "removed", "unique", "covered", "shapley", *[f"lost{g}" for g in range(n_flags)]]
    schema = T.StructType([T.StructField("part", marked.schema["part"].dataType), T.StructField("seen", T.IntegerType()),
                           T.StructField("filter", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in sums]])
    kind_of = pa.array([s for s, _ in steps], pa.int32()), pa.array([f for _, f in steps], pa.int32())

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_held, key, total = 0, None, None

        def close() -> None:
            nonlocal held, n_held, total
            if held:
                ids, bits, flags = (np.concatenate(x) for x in zip(*held, strict=True))
                total = total + block_sizes(ids, bits, flags, k, n_flags)
                held, n_held = [], 0

        def out() -> pa.RecordBatch:
            name = pa.concat_arrays([key] * len(steps))
            return pa.RecordBatch.from_arrays([name, *kind_of, *[pa.array(c) for c in total.T]], names=schema.names)

        for batch in batches:
            if batch.num_rows == 0:
                continue
            code = batch.column(0).dictionary_encode().indices.fill_null(-1).to_numpy()
            starts = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            values = [batch.column(c).to_numpy() for c in (1, 2, 3)]
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(code)], strict=True):
                here = batch.column(0).slice(a, 1)
                if key is None or here.to_pylist() != key.to_pylist():
                    close()
                    if key is not None:
                        yield out()
                    key, total = here, np.zeros((len(steps), len(sums)), np.int64)
                while a < b:
                    end = min(b, a + block_rows - n_held)
                    held.append(tuple(v[a:end] for v in values))
                    n_held, a = n_held + end - a, end
                    if n_held == block_rows:
                        close()
        close()
        if key is not None:
            yield out()

    sizes = (walked.select("part", "row", "bits", "flags").mapInArrow(walk, schema)
             .groupBy("part", "seen", "filter").agg(*[F.sum(c).alias(c) for c in sums]))
    names = list(filters)
    orders = [("".join(names[f] for f in order), i + 1, sum(1 << g for g in order[:i]), f)
              for order in permutations(range(k)) for i, f in enumerate(order)]
    table = spark.createDataFrame(orders, "filter_order string, step int, seen int, filter int")  # k! k rows
    return sizes.join(F.broadcast(table), ["seen", "filter"]).select(
        "part", "filter_order", "step", (F.col("docs") - F.col("covered")).alias("kept"), "removed",
        (F.col("failing") - F.col("removed")).alias("redundant"), F.col("unique").alias("unique_fails"),
        *[F.col(f"lost{g}").alias(name) for g, name in enumerate(lost)], "shapley")


# ---- the marks that a corpus audit needs ------------------------------------


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Mapping[str, Column] | None = None) -> DataFrame:
    """A stored table of ``doc_id``, the ``carry`` columns, ``n_words, n_distinct, n_upper, n_points, has_sign`` and the text's
    ``digest``: whole texts are read once and not kept.  Null texts count as empty."""
    text = docs.select(col(id_col).cast("bigint").alias("doc_id"), *[c.alias(n) for n, c in (carry or {}).items()],
                       F.coalesce(col(text_col), F.lit("")).alias("__text"))
    words = text.withColumn("__words", F.regexp_extract_all("__text", F.lit(f"({WORD})"), F.lit(1)))
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    points = F.length("__text").cast("bigint")
    return stored(words.select(
        "doc_id", *(carry or {}), F.size("__words").cast("bigint").alias("n_words"),
        F.size(F.array_distinct("__words")).cast("bigint").alias("n_distinct"),
        (points - F.length(F.translate("__text", capitals, ""))).alias("n_upper"), points.alias("n_points"),
        F.col("__text").rlike("[#$%&*|]").alias("has_sign"), F.unhex(F.sha2(F.col("__text").cast("binary"), 256)).alias("digest")),
        "audit-features")


def mark_copies(rows: DataFrame, out_col: str = "is_copy", id_col: str = "doc_id", digest_col: str = "digest",
                hot_groups: int = 1000) -> DataFrame:
    """``rows`` (a stored table) with ``out_col``: does an equal digest stand on a row with a smaller id?

    A null id counts as larger than any other; rows that repeat the smallest id
    are no copies of each other.  Groups with more than one of ``hot_groups`` parts of all rows (fewer than ``hot_groups`` can be) are
    looked up by broadcast, in whatever task their rows are; only the others are shuffled.
    """
    first, many, hot = (hidden(rows, x) for x in ("first", "many", "hot"))
    groups = stored(rows.groupBy(col(digest_col)).agg(F.min(col(id_col)).alias(first), F.count(F.lit(1)).alias(many)).where(col(many) > 1),
                    "audit-copies")
    is_hot = col(many) * hot_groups > F.lit(rows.count())
    marked = rows.join(F.broadcast(groups.where(is_hot).select(digest_col, first, F.lit(True).alias(hot))), digest_col, "left")
    cold = marked.where(col(hot).isNull()).drop(first).join(groups.where(~is_hot).select(digest_col, first), digest_col, "left")
    is_copy = F.coalesce(col(id_col) > col(first), col(first).isNotNull())
    parts = [x.select(*[col(c) for c in without(rows, [out_col])], is_copy.alias(out_col)) for x in (marked.where(col(hot).isNotNull()), cold)]
    return parts[0].unionByName(parts[1])


def mark_labels(rows: DataFrame, labels: DataFrame, flags: Mapping[str, Column], id_col: str = "doc_id") -> DataFrame:
    """``rows`` with a boolean per flag: does a row of ``labels`` with this id have it?  Rows without id (or label) have
    none; they are spread by their row number, not joined as one key."""
    found = labels.where(col(id_col).isNotNull()).groupBy(col(id_col).cast("bigint").alias("__key")).agg(
        *[F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in flags.items()]).withColumn("__has", F.lit(True))
    kept = rows.select(*[col(c) for c in without(rows, list(flags))])
    keyed = kept.withColumns({"__has": col(id_col).isNotNull(),
                              "__key": F.coalesce(col(id_col).cast("bigint"), F.xxhash64(F.monotonically_increasing_id()))})
    joined = keyed.join(found, ["__key", "__has"], "left")
    return joined.select(*[col(c) for c in kept.columns], *[F.coalesce(F.col(n), F.lit(False)).alias(n) for n in flags])
