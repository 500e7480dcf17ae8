"""Links between similar sets, and what they connect.

Shared by the near-duplicate operators.  Candidates come from banded
signatures; no step emits all pairs of a band.  The members of a band are
first compared with its smallest member only.  Bands whose members then still
lie in different components are looked at once more in blocks: inside a task
every pair across components is estimated from signatures, and the likely ones
are confirmed on full sets, most similar first, until the block's components
are joined.  A task sends out confirmed links only, fewer than it has members.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import maybe_among, ship, stored

#: Members of a band that one task compares with as many others.
BLOCK = 512
Compare = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
Unpack = Callable[[pa.Array], list[np.ndarray]]


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` (the smallest node) for every node of ``links (a, b)``.

    Distributed union-find: turns of joining each node's larger neighbours,
    then its smaller ones, to its smallest neighbour, until every component is
    a star.  A node with any number of neighbours is a partial aggregate and
    a join, never a list.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    while not _stars(edges):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("comp"))
    return stored(edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots), "components")


def _stars(edges: DataFrame) -> bool:
    """Does every node have one smaller neighbour at most, itself without any?"""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    sums = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return sums.where("up > 1 or up = 1 and down = 1").limit(1).count() == 0


def band_rows(nodes: DataFrame, bands: int, width: int) -> DataFrame:
    """``key, cid, b``: one row per band of each signature (``width`` bytes a band)."""
    exploded = nodes.select("cid", "sig", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("b"))
    return exploded.select(F.xxhash64("b", F.expr(f"substring(sig, b * {width} + 1, {width})")).alias("key"), "cid", "b")


def star_pairs(rows: DataFrame) -> DataFrame:
    """Distinct ``a < b``: one member of each band, as a rule its smallest, with every other.

    Dealt by range of (key, member), so that a band of any size spreads over
    partitions, and sorted by key alone (Spark's radix sort); each partition
    keeps one key and one member.  The members that one band is compared with
    in several partitions are joined up afterwards.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def star(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pivot, first = None, None, True

        def out(a, b, k) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(k, pa.int64())],
                                              names=["a", "b", "key"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, cids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
            pivots = np.minimum.reduceat(cids, starts)
            if first:
                first = False
                yield out([pivots[0]], [None], [keys[0]])
            elif keys[0] == key:
                pivots[0] = pivot  # goes on from the batch before
            pivots, last = np.repeat(pivots, np.diff(np.append(starts, len(keys)))), pivots[-1]
            more = pivots != cids
            if more.any():
                a, b = pivots[more], cids[more]
                yield out(np.minimum(a, b), np.maximum(a, b), np.zeros(len(a), np.int64))
            key, pivot = keys[-1], last
        if not first:
            yield out([pivot], [None], [key])

    found = stored(rows.repartitionByRange(n, "key", "cid").sortWithinPartitions("key")
                   .mapInArrow(star, "a bigint, b bigint, key bigint").where("b is null or a <> b").distinct(), "star")
    ends = found.where("b is null").select("key", "a").distinct()
    seams = ends.groupBy("key").agg(F.min("a").alias("m")).join(ends, "key").where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return found.where("b is not null").select("a", "b").unionByName(seams).distinct()


def shared_enough(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    """den * |both| >= num * |either| for sorted distinct values."""
    if den * min(len(x), len(y)) < num * max(len(x), len(y)):
        return False
    if len(x) > len(y):
        x, y = y, x
    if len(y) == 0:
        return False
    at = np.searchsorted(y, x)
    shared = int((y[np.minimum(at, len(y) - 1)] == x).sum())
    return den * shared >= num * (len(x) + len(y) - shared)


def links_across(rows: DataFrame, compare: Compare, unpack: Unpack, least: float, num: int, den: int, bands: int) -> DataFrame:
    """``a, b``: confirmed links that join different components of a band.

    ``rows``: key, b, n_members, cid, comp, n, sig, items.  A pair is looked at in
    the first band it shares.  Bands of more than ``BLOCK`` members are dealt out
    as pairs of blocks.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = F.ceil(F.col("n_members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cid"), blocks.cast("bigint")).cast("int")
    spread = (rows.withColumns({"own": own, "other": F.explode(F.sequence(F.lit(0), blocks - 1))})
              .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                      "b", "cid", "comp", "n", "sig", "items"))

    def pairs(table: pa.Table) -> pa.RecordBatch:
        ids = [table.column(c).to_numpy() for c in ("key", "i", "j")]
        band, cid, comp, size = (table.column(c).to_numpy() for c in ("b", "cid", "comp", "n"))
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(len(cid), -1)
        group = np.cumsum(np.concatenate([[0], np.any([x[1:] != x[:-1] for x in ids], axis=0)]))
        left, right, score = [], [], []
        for d in range(1, len(cid)):  # partners at distance d of the sorted rows
            i = np.flatnonzero(group[d:] == group[:-d])
            if len(i) == 0:
                break
            j = i + d
            ok = (comp[i] != comp[j]) & (den * np.minimum(size[i], size[j]) >= num * np.maximum(size[i], size[j]))
            i, j = i[ok], j[ok]
            near = compare(sig, size, i, j)
            ok = near >= least
            i, j, near = i[ok], j[ok], near[ok]
            if len(i) == 0:
                continue
            first = (sig[i] == sig[j]).reshape(len(i), bands, -1).all(axis=2).argmax(axis=1) == band[i]
            left.append(i[first]), right.append(j[first]), score.append(near[first])
        i, j, near = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((left, np.int64), (right, np.int64), (score, float)))
        used = np.unique(np.concatenate([i, j]))
        sets = dict(zip(used.tolist(), unpack(table.column("items").take(pa.array(used))), strict=True))
        root: dict[int, int] = {}

        def find(c: int) -> int:
            while (up := root.get(c, c)) != c:
                root[c] = root.get(up, up)
                c = up
            return c

        a, b = [], []
        for k in np.argsort(-near, kind="stable").tolist():
            x, y = int(i[k]), int(j[k])
            p, q = find(int(comp[x])), find(int(comp[y]))
            if p != q and shared_enough(sets[x], sets[y], num, den):
                root[max(p, q)] = min(p, q)
                a.append(min(int(cid[x]), int(cid[y]))), b.append(max(int(cid[x]), int(cid[y])))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([kept, table]).combine_chunks() if kept is not None else table
            last = [table.column(c)[-1].as_py() for c in ("key", "i", "j")]
            open_ = np.all([table.column(c).to_numpy() == v for c, v in zip(("key", "i", "j"), last, strict=True)], axis=0)
            cut = int(np.flatnonzero(open_)[0])  # the last group may go on in the next batch
            if cut:
                yield pairs(table.slice(0, cut).combine_chunks())
            kept = table.slice(cut).combine_chunks()
        if kept is not None:
            yield pairs(kept)

    return (spread.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j", "cid")
            .mapInArrow(run, "a bigint, b bigint"))


def verified(pairs: DataFrame, sets: DataFrame, unpack: Unpack, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar; ``sets``: cid, items."""
    both = (pairs.select("a", "b").join(sets.select(F.col("cid").alias("b"), F.col("items").alias("right")), "b")
            .join(sets.select(F.col("cid").alias("a"), F.col("items").alias("left")), "a").select("a", "b", "left", "right"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                ok = [shared_enough(x, y, num, den) for x, y in zip(unpack(batch.column(2)), unpack(batch.column(3)), strict=True)]
                yield batch.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(check, "a bigint, b bigint")


def near_links(nodes: DataFrame, sets_of: Callable[[DataFrame], DataFrame], unpack: Unpack, bands: int, width: int, num: int, den: int,
               compare: Compare, least: float, estimate_first: bool, alias: DataFrame | None = None) -> DataFrame:
    """``node, comp`` of every node with a confirmed link.

    ``nodes``: cid, sig.  ``sets_of(cids)`` returns ``cid, n, items`` (n: size of the set)
    for the nodes asked for, and ``unpack`` makes sorted distinct 64-bit values of items.
    ``compare(sig, n, i, j)`` estimates the similarity of rows i and j; pairs below
    ``least`` are not confirmed, which holds for the pairs with a band's smallest
    member only if ``estimate_first``.  ``alias`` (cid, rep) names nodes known to be
    equal (other nodes need no row): only representatives are compared.
    """
    spark = nodes.sparkSession
    ship(spark)
    found = star_pairs(band_rows(nodes, bands, width).select("key", "cid"))
    if alias is not None:
        found = (found.join(alias.select(F.col("cid").alias("a"), F.col("rep").alias("ra")), "a", "left")
                 .join(alias.select(F.col("cid").alias("b"), F.col("rep").alias("rb")), "b", "left")
                 .select(F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))
                 .where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    pairs = stored(found, "pairs")
    cids = stored(pairs.select(F.col("a").alias("cid")).unionByName(pairs.select(F.col("b").alias("cid"))).distinct(), "cids")
    near = stored(maybe_among(nodes.select("cid", "sig"), cids, ["cid"]).join(sets_of(cids), "cid")
                  .select("cid", "n", "sig", "items"), "candidates")
    asked = pairs
    if estimate_first:
        side = lambda c, s: near.select(F.col("cid").alias(c), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
        wide = pairs.join(side("a", "l"), "a").join(side("b", "r"), "b").select("a", "b", "n_l", "n_r", "sig_l", "sig_r")

        def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                m = batch.num_rows
                sig = np.frombuffer(b"".join(batch.column(4).to_pylist() + batch.column(5).to_pylist()), np.uint16).reshape(2 * m, -1)
                size = np.concatenate([batch.column(2).to_numpy(), batch.column(3).to_numpy()])
                ok = compare(sig, size, np.arange(m), np.arange(m) + m) >= least
                yield batch.filter(pa.array(ok)).select(["a", "b"])

        asked = wide.mapInArrow(likely, "a bigint, b bigint")
    links = stored(verified(asked, near.select("cid", "items"), unpack, num, den), "links")
    comp = components(links)
    # bands of two have no pair but the one above
    rows = band_rows(near, bands, width)
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n_members")).where("n_members > 2")
    labelled = stored(rows.join(sizes, "key").join(comp.withColumnRenamed("node", "cid"), "cid", "left")
                      .select("key", "cid", "b", "n_members", F.coalesce("comp", "cid").alias("comp")), "bands")
    split = labelled.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("key")
    open_rows = labelled.join(split, "key", "left_semi").join(near, "cid")
    more = stored(links_across(open_rows, compare, unpack, least, num, den, bands).distinct(), "links-across")
    return components(links.unionByName(more))
