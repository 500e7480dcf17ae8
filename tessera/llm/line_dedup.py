"""Fuzzy line deduplication by MinHash.

Lines are sets of character shingles.  Signatures of minimum hashes are cut
into many short bands, candidates are confirmed by exact Jaccard similarity,
a distributed union-find joins what is confirmed, and of each component the
first line stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._common import col, hidden, map_arrow, maybe_among, mix64, ship, stored, text_slices, without
from tessera.llm._links import near_links
from tessera.llm._shingles import hash_runs, min_hashes, powers

#: Registers a band, bands; at a similarity of 0.8 a pair meets in no band with probability 6e-4.
BAND_REGISTERS, BANDS = 4, 14
SHINGLE = 8
#: Slack of the estimate that orders late candidates (about four standard errors of 56 registers).
SLACK = 0.2
_ROLL = 0xC2B2AE3D27D4EB4F
_BACK = pow(_ROLL, -1, 1 << 64)


def line_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(units, starts, ends, document, line number) of all non-blank lines.

    Units are code points with A-Z lower-cased, runs of white space inside a
    line made one space and those at its ends left out.  Lines end at ``\\n``.
    """
    whole = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    first = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
    doc_at = first[offsets]
    if len(whole) == 0:
        none = np.zeros(0, np.int64)
        return whole, none, none, none, none
    low = whole + ((whole >= 65) & (whole <= 90)).astype(np.uint32) * np.uint32(32)
    space = (low == 32) | ((low >= 9) & (low <= 13))
    newline = low == 10
    begins = np.zeros(len(low) + 1, bool)  # of a line
    begins[1:] = newline
    begins[doc_at] = True
    begins = begins[:-1]
    line = np.cumsum(begins) - 1
    previous = np.concatenate([[True], space[:-1]])
    single = space & ~previous & ~begins & ~newline
    keep = ~space | single
    # a space before the end of a line goes too: the next kept unit must be of the same line
    kept = np.flatnonzero(keep)
    same = np.concatenate([line[kept[1:]] == line[kept[:-1]], [False]])
    kept = kept[~space[kept] | same]
    units, of = np.where(space[kept], np.uint32(32), low[kept]), line[kept]
    fresh = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
    starts = np.flatnonzero(fresh)
    ends = np.concatenate([starts[1:], [len(units)]]).astype(np.int64) if len(starts) else starts
    heads = np.flatnonzero(begins)  # first unit of every line, blank ones too
    doc_of = np.searchsorted(doc_at, heads, side="right") - 1
    first_line = np.searchsorted(heads, doc_at[:-1])
    number = np.arange(len(heads)) - first_line[doc_of]
    mine = of[starts]
    return units, starts, ends, doc_of[mine], number[mine]


def char_shingles(units: np.ndarray, starts: np.ndarray, ends: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-character shingles (a shorter line is one), line
    after line, and where each line's begin."""
    count = np.maximum(ends - starts - size + 1, 1)
    first = np.cumsum(count) - count
    at = np.arange(int(count.sum())) + np.repeat(starts - first, count)
    stop = np.minimum(at + size, np.repeat(ends, count))
    total = np.concatenate([[np.uint64(0)], np.cumsum((units.astype(np.uint64) + np.uint64(1)) * powers(_ROLL, len(units)))])
    return mix64((total[stop] - total[at]) * powers(_BACK, len(units) + 1)[at]), first


def distinct_counts(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Number of distinct values of each run (runs begin at ``first`` and are not empty)."""
    count = np.diff(np.append(first, len(values)))
    own = values ^ np.repeat(mix64(np.arange(1, len(first) + 1, dtype=np.uint64)), count)  # equal in one run only, but for chance
    ordered = np.sort(own)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if len(twice):
        marked = np.zeros(1 << 22, bool)
        low = np.uint64(len(marked) - 1)
        marked[twice & low] = True
        at = np.flatnonzero(marked[own & low])
        for k in np.unique(np.searchsorted(first, at, side="right") - 1).tolist():
            count[k] = len(np.unique(values[first[k]:first[k] + count[k]]))
    return count


def unpack(items: pa.Array) -> list[np.ndarray]:
    """Shingle sets of lines kept as text."""
    out = []
    for _, _, data, offsets in text_slices(items):
        units, starts, ends, _, _ = line_units(data, offsets)
        grams, first = char_shingles(units, starts, ends, SHINGLE)
        out += [np.unique(grams[a:b]) for a, b in zip(first.tolist(), [*first[1:].tolist(), len(grams)], strict=True)]
    return out


def estimate(sig: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    return (sig[i] == sig[j]).mean(1) if len(i) else np.zeros(0)


def line_components(docs: DataFrame, text_col: str, id_col: str, num: int = 80, den: int = 100) -> DataFrame:
    """``rid, line_no, kept`` of every non-blank line that has a similar one.

    ``docs`` must give the same partitions each time it is read.
    """
    spark = docs.sparkSession
    ship(spark)
    base = docs.select(F.monotonically_increasing_id().alias("rid"), col(id_col).cast("bigint").alias("doc_id"),
                       col(text_col).alias("text"))
    functions = BAND_REGISTERS * BANDS

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, int], int] = {}  # lines of this task, for at most 200,000
        number = 0
        for batch in batches:
            rids = batch.column(0).to_numpy()
            ids = batch.column(1)
            for low, _, data, offsets in text_slices(batch.column(2)):
                units, starts, ends, doc, line_no = line_units(data, offsets)
                if len(starts) == 0:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                x = hash_runs(units, starts, ends).view(np.int64)
                y = hash_runs(units ^ np.uint32(0x2545F491), starts, ends).view(np.int64)
                lid = (rids[low + doc[0]] >> 33 << 33) + number + np.arange(len(starts))
                number += len(starts)
                cid = np.empty(len(starts), np.int64)
                fresh = []
                for k, pair in enumerate(zip(x.tolist(), y.tolist(), strict=True)):
                    got = seen.get(pair)
                    if got is None:
                        got = seen[pair] = int(lid[k])
                        fresh.append(k)
                    cid[k] = got
                sig: list[bytes | None] = [None] * len(starts)
                if fresh:
                    new = np.array(fresh)
                    grams, first = char_shingles(units, starts[new], ends[new], SHINGLE)
                    for k, row in zip(fresh, min_hashes(grams, first, functions).astype(np.uint16), strict=True):
                        sig[k] = row.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lid), pa.array(rids[low + doc]), ids.take(pa.array(low + doc)), pa.array(line_no.astype(np.int32)),
                     pa.array(cid), pa.array(x), pa.array(y), pa.array(sig, pa.binary())],
                    names=["lid", "rid", "doc_id", "line_no", "cid", "x", "y", "sig"])

    lines = stored(base.mapInArrow(sketch, "lid bigint, rid bigint, doc_id bigint, line_no int, cid bigint, x bigint, "
                                           "y bigint, sig binary"), "lines")
    nodes = lines.where("sig is not null")
    # a task names the copies of a line by the first; across tasks equal hashes name them
    reps = nodes.groupBy("x", "y").agg(F.min("cid").alias("rep"), F.count(F.lit(1)).alias("k"))
    reps = stored(reps.where("k > 1").drop("k"), "line-classes")
    alias = stored(maybe_among(nodes.select("cid", "x", "y"), reps, ["x", "y"]).join(reps, ["x", "y"]).select("cid", "rep"), "aliases")

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(1)):
                units, starts, ends, _, _ = line_units(data, offsets)
                part = batch.slice(low, high - low)
                size = distinct_counts(*char_shingles(units, starts, ends, SHINGLE))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), part.column(1)], names=["cid", "n", "items"])

    def sets_of(cids: DataFrame) -> DataFrame:
        where = maybe_among(lines.where("lid = cid").select("cid", "rid", "line_no"), cids, ["cid"]).join(cids.select("cid"), "cid", "left_semi")
        where = stored(where, "wanted")
        texts = maybe_among(base.select("rid", "text"), where, ["rid"])
        parts = texts.select("rid", F.posexplode(F.split("text", "\n")).alias("line_no", "items"))
        found = maybe_among(parts, where, ["rid", "line_no"]).join(where, ["rid", "line_no"]).select("cid", "items")
        return found.mapInArrow(sized, "cid bigint, n bigint, items string")

    comp = near_links(nodes.select("cid", "sig"), sets_of, unpack, BANDS, 2 * BAND_REGISTERS, num, den, estimate, num / den - SLACK,
                      estimate_first=False, alias=alias)
    # every other line is the only one of its root
    linked = comp.select(F.col("node").alias("cid")).unionByName(alias.select("cid")).unionByName(lines.where("lid <> cid").select("cid"))
    linked = stored(linked.distinct(), "linked")
    roots = (linked.join(alias, "cid", "left").select("cid", F.coalesce("rep", "cid").alias("rep"))
             .join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("cid", F.coalesce("comp", "rep").alias("root")))
    span = F.lit(str(2**63)).cast("decimal(19,0)")
    order = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), span.cast("decimal(20,0)")) * span + F.col("lid")
    member = stored(maybe_among(lines.select("lid", "rid", "line_no", "cid", order.alias("ord")), linked, ["cid"]).join(roots, "cid")
                    .select("rid", "line_no", "root", "ord"), "line-members")
    heads = member.groupBy("root").agg(F.min("ord").alias("head"), F.count(F.lit(1)).alias("k")).where("k > 1")
    return member.join(heads, "root").select("rid", "line_no", (F.col("ord") == F.col("head")).alias("kept"))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 80, den: int = 100,
               materialise: bool = True) -> DataFrame:
    """``docs`` with near-duplicate lines taken out of ``text_col``, and ``n_lines,
    n_dropped`` (of non-blank lines).

    Two lines are linked if the sets of their 8-character shingles (a shorter
    line is one shingle), after lower-casing A-Z and white space made single,
    have den * |both| >= num * |either|.  Of all lines that links connect, in
    one document or several, the first by (id, row, line) stays; rows
    without id come last.  Blank lines stay where they are and count for nothing.
    Null and empty texts come back as they are; repeated rows lose their lines
    to the first of them; an empty table gives an empty result; input columns
    named ``n_lines`` or ``n_dropped`` give way.  A text of very many lines takes time in proportion to them.

    ``materialise=False`` is for inputs that give the same partitions each time
    they are read (a plain table scan).
    """
    spark = docs.sparkSession
    ship(spark)
    keep = without(docs, ["n_lines", "n_dropped"])
    docs = docs.select(*[col(c) for c in keep])
    if materialise:
        docs = stored(docs, "line-docs")
    lines = line_components(docs, text_col, id_col, num, den)
    drops = stored(lines.where(~F.col("kept")).groupBy("rid").agg(F.collect_list("line_no").alias("drop")), "drops")
    rid, drop = hidden(docs, "rid"), hidden(docs, "drop")
    numbered, drops = docs.withColumn(rid, F.monotonically_increasing_id()), drops.select(F.col("rid").alias(rid), F.col("drop").alias(drop))
    whole = maybe_among(numbered, drops, [rid], others=True).withColumn(drop, F.lit(None).cast("array<int>"))  # keeps all its lines
    # the plan of a large input at any size: no broadcast of what grows with the input
    frame = maybe_among(numbered, drops, [rid]).join(drops.hint("merge"), rid, "left").select(*[col(c) for c in whole.columns]).union(whole).drop(rid)
    at = frame.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text, gone = batch.column(at), batch.column(batch.num_columns - 1)
            lines_ = pc.fill_null(pc.count_substring_regex(text, r"[^ \t\n\v\f\r][^\n]*"), 0).cast(pa.int64())
            dropped = pc.fill_null(pc.list_value_length(gone), 0).cast(pa.int64())
            shorter = []
            for k in np.flatnonzero(dropped.to_numpy()).tolist():
                out = set(gone[k].as_py())
                shorter.append("\n".join(p for i, p in enumerate(text[k].as_py().split("\n")) if i not in out))
            columns = list(batch.columns[:-1])
            if shorter:
                columns[at] = pc.replace_with_mask(text, pc.greater(dropped, 0), pa.array(shorter, text.type))
            yield pa.RecordBatch.from_arrays([*columns, lines_, dropped], names=schema.names)

    return map_arrow(frame, cut, schema)
