"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives every vector a long string of hash bits; sorted, the strings
form the tree.  A query descends to the longest prefixes it shares and then
ascends all trees together, one bit at a time, until its prefixes hold enough
strings; one step up at most doubles an even tree's share.  In Spark a tree is
a set of cells (tree, first bits), whose strings are sorted inside a task: a
first pass counts, for each query, the strings below each of its prefixes,
which says how far it ascends; a second takes the ids below the prefix found.
The ids meet the vectors once, by blocks of points, and are scored there.

The first bits are a cross-polytope hash (the largest coordinate after a
random projection, with its sign), the others signs of random projections.
Inner product becomes angle by one more coordinate, which takes up what a
vector lacks in length.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._common import col, mix64, ship, stored

#: Trees, and bits of a string: those of the first hash, then single ones.
TREES, FIRST_BITS, BITS = 128, 7, 32
#: Strings that a task sorts at once, vectors that it scores at once, and
#: about how many candidates it gives out or scores at once; strings below one
#: query's prefixes that are merged at once.
STRING_BLOCK, POINT_BLOCK, PAIR_BLOCK, LIST_BLOCK = 1 << 16, 1 << 14, 1 << 23, 1 << 20
#: Strings of a tree that an even cell of the first round holds, and the bits a round ascends.
CELL_STRINGS, ROUND_BITS = 1 << 18, 4


def hash_strings(vectors: np.ndarray, lengths: np.ndarray, longest: float, seed: int) -> np.ndarray:
    """(vectors, trees) strings of ``BITS`` bits as integers; ``longest`` 0
    hashes queries, which have no length to make up."""
    n, dim = vectors.shape
    lift = np.zeros(n) if longest <= 0 else np.sqrt(np.maximum(0, 1 - (lengths / longest) ** 2))
    scaled = vectors / (lengths[:, None] if longest <= 0 else longest)
    x = np.concatenate([scaled, lift[:, None]], axis=1).astype(np.float32)
    wide, single = 1 << (FIRST_BITS - 1), BITS - FIRST_BITS
    weights = 1 << np.arange(single - 1, -1, -1, dtype=np.int64)
    out = np.zeros((n, TREES), np.int64)
    for t in range(TREES):
        y = x @ np.random.default_rng([seed, t]).standard_normal((dim + 1, wide + single)).astype(np.float32)
        at = np.abs(y[:, :wide]).argmax(1)
        first = (y[np.arange(n), at] > 0) * wide + at  # the sign leads: what is left when a query goes up is no opposite
        out[:, t] = first << single | (y[:, wide:] > 0) @ weights
    return out


def shared_bits(codes: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Length of the prefix that each string shares with the query's."""
    differ = (codes ^ mine).astype(np.float64)
    return BITS - np.maximum((differ.view(np.int64) >> 52) - 1022, 0)


def scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal rows get equal values."""
    return (vectors * query).sum(axis=1)


def nearest(ids: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest values, ties to smaller ids."""
    if len(ids) > 4 * k:
        bar = np.partition(values, len(values) - k)[len(values) - k]
        some = np.flatnonzero(values >= bar)
    else:
        some = np.arange(len(ids))
    return some[np.lexsort((ids[some], -values[some]))[:k]]


def vector_table(frame: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` (array<double>) of the rows that take part."""
    v = col(vector_col)
    usable = (col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)
              & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0))
    rows = frame.where(usable).select(col(id_col).cast("bigint").alias("vec_id"), v.cast("array<double>").alias("vector"))
    first = F.row_number().over(Window.partitionBy("vec_id").orderBy(F.xxhash64("vector"), "vector"))
    return rows.withColumn("r", first).where("r = 1").drop("r")


def _cells(index: DataFrame, asks: DataFrame, bits: int, emits: bool) -> tuple[DataFrame, DataFrame, list[str]]:
    """The strings of points and queries, dealt to tasks by cell (tree, first
    ``bits``): a cell of many points is cut in blocks that all its queries
    visit, one whose queries ask for many ids (``emits``) in blocks of queries."""
    def strings(frame: DataFrame, *carry: str) -> DataFrame:
        rows = frame.select("vec_id", *carry, F.posexplode("codes").alias("tree", "code"))
        return rows.withColumn("cell", F.shiftright("code", BITS - bits))

    cell = ["tree", "cell"]
    load = F.sum("load") if emits else F.lit(0)
    sizes = (strings(index).groupBy(*cell).agg(F.count(F.lit(1)).alias("n"))
             .join(strings(asks, "load").groupBy(*cell).agg(F.count(F.lit(1)).alias("nq"), load.alias("m")), cell)
             .select(*cell, F.ceil(F.col("n") / STRING_BLOCK).alias("pb"),
                     F.greatest(F.ceil(F.col("m") / PAIR_BLOCK), F.ceil(F.col("nq") / STRING_BLOCK)).cast("bigint").alias("qb")))
    sizes = stored(sizes, "cells")
    salt = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = strings(index).join(sizes, cell).withColumns({"i": salt("pb"), "j": every("qb")}).select(*cell, "i", "j", "vec_id", "code")
    carry = ["x", "parts"] if emits else []
    right = strings(asks, *carry).join(sizes, cell).withColumns({"j": salt("qb"), "i": every("pb")}).select(*cell, "i", "j", "vec_id", "code", *carry)
    return left, right, [*cell, "i", "j"]


def _counts(index: DataFrame, asks: DataFrame, bits: int) -> DataFrame:
    """``vec_id, c1 .. c32``: strings of all trees below each prefix of a query,
    right from the first ``bits`` on."""
    left, right, keys = _cells(index, asks, bits, False)

    def count(points: pa.Table, queries: pa.Table) -> pa.Table:
        codes = np.sort(points.column("code").to_numpy())
        mine = queries.column("code").to_numpy()
        cols = [queries.column("vec_id").combine_chunks()]
        for x in range(1, BITS + 1):
            low = mine >> (BITS - x) << (BITS - x)
            cols.append(pa.array(np.searchsorted(codes, low + (1 << (BITS - x))) - np.searchsorted(codes, low), pa.int64()))
        return pa.table(cols, names=["vec_id", *[f"c{x}" for x in range(1, BITS + 1)]])

    levels = [f"c{x}" for x in range(1, BITS + 1)]
    parts = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(count, "vec_id bigint, " + ", ".join(f"{c} bigint" for c in levels))
    return parts.groupBy("vec_id").agg(*[F.sum(c).alias(c) for c in levels])


def _below(index: DataFrame, asks: DataFrame, bits: int) -> DataFrame:
    """``query_id, part, ids``: points below the query's prefix of ``x`` bits
    in one tree; a query of very many is cut in ``parts`` by id."""
    left, right, keys = _cells(index, asks, bits, True)

    def take(points: pa.Table, queries: pa.Table) -> pa.Table:
        codes, ids = points.column("code").to_numpy(), points.column("vec_id").to_numpy()
        order = np.argsort(codes, kind="stable")
        codes, ids = codes[order], ids[order]
        mine, x = queries.column("code").to_numpy(), queries.column("x").to_numpy().astype(np.int64)
        low = mine >> (BITS - x) << (BITS - x)
        first, end = np.searchsorted(codes, low), np.searchsorted(codes, low + (1 << (BITS - x)))
        rows: list[tuple[int, int, np.ndarray]] = []
        for q, n, a, b in zip(queries.column("vec_id").to_pylist(), queries.column("parts").to_pylist(), first.tolist(), end.tolist(), strict=True):
            if a < b:
                rows += [(q, part, some) for part, some in (_split(ids[a:b], n) if n > 1 else [(0, ids[a:b])])]
        return _lists(rows, ["query_id", "part", "ids"])

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(take, "query_id bigint, part int, ids array<bigint>")


def _split(ids: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """(number, ids) of the non-empty ones of ``n`` parts by id."""
    part = (mix64(ids.astype(np.uint64)) % np.uint64(n)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    some, first = np.unique(part[order], return_index=True)
    return list(zip(some.tolist(), np.split(ids[order], first[1:]), strict=True))


def _lists(rows: list[tuple[int, int, np.ndarray]], names: list[str]) -> pa.Table:
    """A table of a query, a number and a list of ids a row."""
    flat = np.concatenate([r[2] for r in rows]) if rows else np.zeros(0, np.int64)
    offsets = np.cumsum([0, *[len(r[2]) for r in rows]]).astype(np.int32)
    return pa.table([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=names)


def forest_search(points: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
                  target_recall: float = 0.96, sample_queries: int = 64, seed: int = 7, with_scored: bool = False) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the ``k`` found with the
    largest inner product, a query's own id left out, ties to the smaller id.
    ``with_scored`` adds ``scored``, the number of points it was compared with.

    Rows whose id or vector is null, or whose vector is empty, zero, holds null
    or non-finite components or has another number of them than most take no
    part; of rows that repeat an id one takes part (the least by hash, then by
    value); other columns are not looked at; empty tables give an empty result.
    Vectors may be of any length (a block of points holds ``POINT_BLOCK`` of them).

    Every vector is indexed; of equal vectors only the ``k + 1`` smallest ids
    can be among anyone's ``k`` nearest, and only these are strings of the
    forest.  For how many strings a query ascends is fitted on at most
    ``sample_queries`` queries (a documented bound): their exact neighbours over
    all points say which count reaches ``target_recall``.  A query goes up to the
    first bit at most, never to the roots.
    """
    spark = points.sparkSession
    ship(spark)
    base = stored(vector_table(points, id_col, vector_col), "vectors")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    dims = base.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max(length).alias("m")).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score double" + (", scored bigint" if with_scored else "")
    if not dims:
        return spark.createDataFrame([], schema)
    dim, n_points, longest = max(dims, key=lambda r: (r["n"], r["d"]))
    same = F.size("vector") == dim
    blocks = -(-n_points // POINT_BLOCK)

    def indexed(kind: float):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                flat = batch.column(1).flatten().to_numpy().reshape(-1, dim)
                for a in range(0, batch.num_rows, 2048):
                    x, ids = flat[a:a + 2048], batch.column(0).slice(a, 2048)
                    codes = hash_strings(x, np.sqrt((x * x).sum(1)), kind, seed)
                    cells = pa.array([v.tobytes() for v in np.ascontiguousarray(x)], pa.binary())
                    rows = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, TREES, dtype=np.int32), pa.array(codes.reshape(-1)))
                    blk = (mix64(ids.to_numpy().astype(np.uint64)) % np.uint64(blocks)).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([ids, cells, rows, pa.array(blk)], names=["vec_id", "vec", "codes", "blk"])
        return run

    kinds = "vec_id bigint, vec binary, codes array<bigint>, blk int"
    copies = Window.partitionBy("vector").orderBy("vec_id")
    telling = base.where(same).withColumn("r", F.row_number().over(copies)).where(F.col("r") <= k + 1).select("vec_id", "vector")
    index = stored(telling.mapInArrow(indexed(float(longest)), kinds), "forest")
    asked = stored(vector_table(queries, id_col, vector_col).where(same).mapInArrow(indexed(0.0), kinds), "queries")

    # how many strings: exact neighbours of a bounded sample of the queries
    sample = asked.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_queries).collect()
    if not sample:
        return spark.createDataFrame([], schema)
    s_ids = np.array([r["vec_id"] for r in sample], np.int64)
    s_vec = [np.frombuffer(bytes(r["vec"]), np.float64) for r in sample]
    s_codes = np.array([r["codes"] for r in sample], np.int64).reshape(len(sample), TREES)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["q", "vec_id", "score", "depth", "counts"]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            vectors = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.float64).reshape(-1, dim)
            codes = batch.column(2).flatten().to_numpy().reshape(-1, TREES)
            for q in range(len(s_ids)):
                depth = shared_bits(codes, s_codes[q])
                counts = np.bincount(depth.ravel(), minlength=BITS + 1)[::-1].cumsum()[::-1][1:]
                values = np.where(ids == s_ids[q], -np.inf, scores(vectors, s_vec[q]))
                top = nearest(ids, values, k)
                top = top[values[top] > -np.inf]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top) + 1, q, np.int32)), pa.array([*ids[top].tolist(), None], pa.int64()),
                     pa.array([*values[top].tolist(), None], pa.float64()),
                     pa.array([*depth[top].max(axis=1).tolist(), None], pa.int32()),
                     pa.array([None] * len(top) + [counts.tolist()], pa.list_(pa.int64()))], names=names)

    probed = stored(index.mapInArrow(probe, "q int, vec_id bigint, score double, depth int, counts array<bigint>"), "probe")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    truth = probed.where("vec_id is not null").withColumn("r", F.row_number().over(best)).where(F.col("r") <= k).collect()
    sums = probed.where("counts is not null").groupBy("q").agg(
        *[F.sum(F.get("counts", F.lit(x - 1))).alias(f"c{x}") for x in range(1, BITS + 1)]).collect()
    enough = _enough(truth, sums, len(sample), k, target_recall)

    def candidates(rest: DataFrame, enough: int) -> DataFrame:
        """``query_id, blk, ids``: small cells first; a query that needs more
        than its cell goes on in larger ones; ids from all trees, once each,
        by block of points."""
        bits = max(0, (n_points - 1).bit_length() - (CELL_STRINGS - 1).bit_length())
        found = []
        while True:
            counts = _counts(index, rest, bits)
            deep = [F.when(F.col(f"c{x}") >= enough, x) for x in range(BITS, max(bits, 1) - 1, -1)]
            x = F.coalesce(*deep, *([F.lit(1)] if bits == 0 else []))
            at = stored(counts.select("vec_id", x.alias("x"), F.array(*[f"c{i}" for i in range(1, BITS + 1)]).alias("c")).where("x is not null")
                        .withColumn("n", F.get("c", F.col("x") - 1))
                        .select("vec_id", "x", (F.col("n") * 4 / TREES).cast("bigint").alias("load"),
                                F.ceil(F.col("n") / LIST_BLOCK).cast("int").alias("parts")), "depths")
            found.append(_below(index, asked.select("vec_id", "codes").join(at, "vec_id"), bits))
            if bits == 0:
                break
            rest, bits = rest.join(at, "vec_id", "left_anti"), max(0, bits - ROUND_BITS)
        def merge(table: pa.Table) -> pa.Table:
            ids = np.unique(table.column("ids").combine_chunks().flatten().to_numpy())
            q = table.column("query_id")[0].as_py()
            return _lists([(q, block, some) for block, some in _split(ids, blocks)], ["query_id", "blk", "ids"])

        every = reduce(DataFrame.unionByName, found).groupBy("query_id", "part")
        return stored(every.applyInArrow(merge, "query_id bigint, blk int, ids array<bigint>"), "candidates")

    # points near a query stand below it in many trees; where that leaves too few, it asks again for a count that cannot
    every = asked.select("vec_id", "codes", F.lit(0).cast("bigint").alias("load"))
    lists = candidates(every, enough)
    have = lists.groupBy(F.col("query_id").alias("vec_id")).agg(F.sum(F.size("ids")).alias("n")).where(F.col("n") > k)
    short = stored(every.join(have, "vec_id", "left_anti"), "short")
    if not short.isEmpty():
        ids = short.select(F.col("vec_id").alias("query_id"))
        lists = lists.join(ids, "query_id", "left_anti").unionByName(candidates(short, max(enough, (k + 1) * TREES)))

    # the ids of one block of points meet its vectors once
    parts = stored(lists.groupBy("blk").agg(F.ceil(F.sum(F.size("ids")) / PAIR_BLOCK).alias("parts")), "candidate-sizes")
    left = index.join(parts, "blk").select("blk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("i"), "vec_id", "vec")
    right = (lists.join(parts, "blk").join(asked.select(F.col("vec_id").alias("query_id"), "vec"), "query_id")
             .select("blk", F.pmod(F.xxhash64("query_id"), "parts").alias("i"), "query_id", "ids", "vec"))

    def score(points: pa.Table, queries: pa.Table) -> pa.Table:
        ids = points.column("vec_id").to_numpy()
        vectors = np.frombuffer(b"".join(points.column("vec").to_pylist()), np.float64).reshape(-1, dim)
        order = np.argsort(ids)
        ids, vectors = ids[order], vectors[order]
        out: list[list] = [[], [], [], []]
        for row in range(queries.num_rows):
            q = queries.column("query_id")[row].as_py()
            mine = queries.column("ids")[row].values.to_numpy()
            at = np.searchsorted(ids, mine[mine != q])
            values = scores(vectors[at], np.frombuffer(queries.column("vec")[row].as_py(), np.float64))
            top = nearest(ids[at], values, k)
            out[0].append(np.full(len(top), q)), out[1].append(ids[at][top]), out[2].append(values[top])
            out[3].append(np.where(np.arange(len(top)) == 0, len(at), 0))
        kinds = (np.int64, np.int64, np.float64, np.int64)
        return pa.table([pa.array(np.concatenate(c) if c else np.zeros(0, t), pa.from_numpy_dtype(t)) for c, t in zip(out, kinds, strict=True)],
                        names=["query_id", "vec_id", "score", "n"])

    keys = ["blk", "i"]
    ranked = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, "query_id bigint, vec_id bigint, score double, n bigint")
    mine = Window.partitionBy("query_id")
    ranked = ranked.withColumns({"scored": F.sum("n").over(mine), "rank": F.row_number().over(mine.orderBy(F.desc("score"), "vec_id"))})
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", *(["scored"] if with_scored else []))


def _enough(truth, sums, n_queries: int, k: int, target: float) -> int:
    """The least count of strings (of a geometric series) whose prefixes reach
    ``target`` recall on the sample; beyond all counts, the first bit is as
    high as it goes.  A query's own strings count, one a tree."""
    counts = {r["q"]: [r[f"c{x}"] for x in range(1, BITS + 1)] for r in sums}
    enough = TREES + k
    while True:
        depth = {q: max((x for x, c in enumerate(counts.get(q, ()), 1) if c >= enough), default=1) for q in range(n_queries)}
        hit = sum(r["depth"] >= depth[r["q"]] for r in truth)
        if hit >= target * len(truth) or all(x == 1 for x in depth.values()):
            return enough
        enough += enough // 4
