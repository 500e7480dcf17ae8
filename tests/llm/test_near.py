"""Near-duplicate documents and lines against brute force."""

import time
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import _links, _shingles, near_dedup as near
from tessera.llm._common import maybe_among
from tessera.llm.line_dedup import SHINGLE, distinct_counts, line_dedup

from .conftest import SF01
from .helpers import line_of, linked, word_set


def _varied(rng, words, share):
    return [rng.choice(VOCABULARY) if rng.random() < share else w for w in words]


VOCABULARY = [f"w{i}" for i in range(4000)]


@pytest.fixture(scope="module")
def families():
    """Texts with chains and clouds of variants around the threshold."""
    rng = random.Random(3)
    texts = []
    for size, share in ((40, 0.03), (30, 0.06), (25, 0.1), (1, 0)):
        base = [rng.choice(VOCABULARY) for _ in range(rng.choice([30, 120, 400]))]
        for _ in range(size):
            texts.append(_varied(rng, base, share * rng.random()))
    chain = [rng.choice(VOCABULARY) for _ in range(200)]
    for _ in range(25):  # each near the last only
        chain = _varied(rng, chain, 0.02)
        texts.append(chain)
    texts += [chain[:k] for k in (1, 2, 3, 4, 5, 199)]
    rng.shuffle(texts)
    return [" ".join(t) for t in texts]


def _components(texts, words):
    sets = {i: word_set(t or "", words) for i, t in enumerate(texts)}
    return sets, linked(sets)


def test_families(spark, families):
    docs = spark.createDataFrame(list(enumerate(families)), "doc_id bigint, text string").repartition(4)
    sets, root = _components(families, 4)
    got = near.near_dedup(docs, words=4).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {
        i: (len(sets[i]), root[i], root[i] == i) for i in sets}


def test_edges(edges, nothing):
    source = edges.collect()
    got = near.near_dedup(edges).collect()
    assert len(got) == len(source)
    assert sorted((str(r["doc_id"]), r["n_shingles"]) for r in got) == sorted((str(r["doc_id"]), len(word_set(r["text"] or "", 5))) for r in source)
    by = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got}
    assert {c for (i, n), c in by.items() if i in (7, 8)} == {7} and by[10, 6] == 9 and by[0, 0] == 0 and by[1, 0] == 1
    # white space and case are nothing; another row has id 5 too
    assert by[6, 1] == 4 and {r["component_id"] for r in got if r["doc_id"] == 5} == {4, 5}
    a_rows = [r for r in got if r["n_shingles"] == 1 and r["component_id"] == 3]
    assert len(a_rows) == 4 and sum(r["kept"] for r in a_rows) == 1  # doc 3 three times and one without id
    assert near.near_dedup(nothing).collect() == []


def test_registers_and_estimate():
    rng = np.random.default_rng(97)  # not the seed of the hash functions: their stream must not be the values'
    assert near.registers(np.array([0, 1, 2**31, 2**32 - 1], np.uint32)).tolist() == [32 << 10, 31 << 10, 0, 1023]
    values = rng.integers(0, 2**63, 3000, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    for shared in (0, 500, 800, 950):
        flat = np.concatenate([values[:1000], values[1000 - shared:2000 - shared]])
        sig = near.registers(_shingles.min_hashes(flat, np.array([0, 1000]), 2048))
        n = np.array([1000, 1000])
        got = near.estimate(sig, n, np.array([0]), np.array([1]))[0]
        assert abs(got - shared / (2000 - shared)) < 0.06
    # chance equality of registers of unrelated sets, against simulation
    unrelated = near.registers(_shingles.min_hashes(rng.integers(0, 2**63, 40000, dtype=np.int64).astype(np.uint64) * np.uint64(2),
                                                    np.arange(0, 40000, 200), 512))
    same = np.mean([(unrelated[i] == unrelated[j]).mean() for i in range(60) for j in range(i)])
    assert abs(same - near.chance(np.array([200]), np.array([200]))[0]) < 2e-4


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(2)
    edges_ = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    edges_ += [(rng.randint(1000, 1400), rng.randint(1000, 1400)) for _ in range(250)]
    rng.shuffle(edges_)
    got = dict(map(tuple, _links.components(spark.createDataFrame(edges_, "a bigint, b bigint")).collect()))
    root = linked({n: {("e", k) for k, e in enumerate(edges_) if n in e} for n in {x for e in edges_ for x in e}}, 0, 1)
    assert got == {n: r for n, r in root.items() if n != 300}
    assert _links.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_stars_of_one_band_over_many_partitions(spark):
    rows = spark.range(5000).select(F.lit(7).cast("bigint").alias("key"), F.col("id").alias("cid")).unionByName(
        spark.range(100).select((F.col("id") + 10).alias("key"), F.col("id").alias("cid")))
    pairs = _links.star_pairs(rows.repartition(5)).collect()
    assert len(pairs) == 4999 and len({r["b"] for r in pairs}) == 4999
    comp = _links.components(spark.createDataFrame(pairs))
    assert comp.where("comp = 0").count() == 5000


def _deduped(docs):
    """(id, row) -> text without lines like earlier ones, by brute force."""
    lines = {}
    for key, text in docs:
        for k, part in enumerate((text or "").split("\n")):
            if line_of(part):
                lines[key, k] = line_of(part)
    order = sorted(lines, key=lambda x: ((x[0][0] is None, x[0][0] or 0, x[0][1]), x[1]))
    sets = {i: frozenset(lines[key][a:a + SHINGLE] for a in range(max(1, len(lines[key]) - SHINGLE + 1))) for i, key in enumerate(order)}
    root = linked(sets)
    gone = {order[i] for i in sets if root[i] != i}
    return {key: "\n".join(p for k, p in enumerate((text or "").split("\n")) if (key, k) not in gone) for key, text in docs}


def test_lines_of_edges(edges, nothing):
    source = edges.collect()
    got = line_dedup(edges.withColumn("N_LINES", F.lit("x"))).collect()
    assert len(got) == len(source)
    # rows that repeat an id and a text are told apart by nothing but their number
    want = _deduped([((r["doc_id"], k), r["text"]) for k, r in enumerate(source)])
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in got) == sorted((str(k[0]), t) for k, t in want.items())
    assert [r["text"] for r in got if r["doc_id"] == 0] == [None]
    assert {r["n_lines"] for r in got if r["doc_id"] in (0, 1, 2)} == {0}
    assert line_dedup(nothing).collect() == []


def test_fuzzy_lines(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice(VOCABULARY) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    docs = []
    for i in range(120):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 4)):
                line[rng.randrange(len(line))] = rng.choice("xyzé ")
            lines.append(rng.choice(["", "  "]) + "".join(line).upper() if rng.random() < 0.3 else "".join(line))
        docs.append((i, "\n".join(lines)))
    got = {r["doc_id"]: r["text"] for r in line_dedup(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)).collect()}
    want = _deduped([((i, 0), t) for i, t in docs])
    assert got == {k[0]: t for k, t in want.items()}


def test_repeated_shingles_are_counted_once(spark):
    rng = random.Random(11)
    base = "".join(rng.choice("abcdefghij klmnop") for _ in range(120))
    docs = []
    for _ in range(300):  # first members of the two lines' bands, similar to neither
        at = rng.randrange(20, len(base) - 32)
        docs.append(base[:at] + "".join(rng.choice("qrstuvwxyz") for _ in range(12)) + base[at + 12:] + "." * 20 + " 5")
    docs += [base + "." * 20 + " 5", base + "." * 200 + " 5"]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string").coalesce(1)
    got = {r["doc_id"]: r["text"] for r in line_dedup(frame).collect()}
    assert got == {k[0]: t for k, t in _deduped([((i, 0), t) for i, t in enumerate(docs)]).items()}
    assert [i for i, t in got.items() if not t] == [301]


def test_slices_of_fewer_words_than_a_shingle():
    for text in (b"a", b"a b", b"a b c", b"a b c d"):
        assert [len(v) for v in _shingles.word_shingles(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 5)] == [1]


def test_distinct_counts_of_runs():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 40, 5000, dtype=np.int64).astype(np.uint64)
    first = np.unique(np.concatenate([[0], rng.integers(1, 5000, 300)]))
    want = [len(set(v.tolist())) for v in np.split(values, first[1:])]
    assert distinct_counts(values, first).tolist() == want
    assert distinct_counts(np.arange(7, dtype=np.uint64), np.array([0, 3])).tolist() == [3, 4]


def test_queries_on_whole_tables(spark, docs01):
    from tessera.llm.queries import QUERIES

    got = {r["doc_id"]: r for r in QUERIES["op3_near_dedup"](spark, SF01).collect()}
    sets = {i: word_set(t, 4) for i, t in docs01.items()}
    root = linked(sets)
    assert {i: (r["n_shingles"], r["component_id"], r["kept"]) for i, r in got.items()} == {i: (len(sets[i]), root[i], root[i] == i) for i in sets}
    lines = {r["doc_id"]: r["text"] or "" for r in QUERIES["op6_line_dedup"](spark, SF01).collect()}
    assert lines == {k[0]: t for k, t in _deduped([((i, 0), t) for i, t in sorted(docs01.items())]).items()}


def test_texts_of_many_lines_take_linear_time(spark):
    """Two near-equal documents of n lines each: four times the lines take far less than sixteen times as long."""
    took = {}
    for n in (100, 2_000, 8_000):
        rows = [(d, "\n".join(f"line {k * 7919 % 1_000_003} of a text with words {k} in it, document {'ab'[d] if k % 50 == 0 else 'a'}" for k in range(n))) for d in (0, 1)]
        frame = spark.createDataFrame(rows, "doc_id bigint, text string")
        began = time.perf_counter()
        out = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in line_dedup(frame).collect()}
        took[n] = time.perf_counter() - began
        assert out[1][0] == n and out[1][1] >= n * 0.9
    assert took[8_000] < 4 * took[2_000]


def test_rows_among_keys_pass_and_few_others(spark):
    keys = spark.range(0, 300_000, 1000).select((F.col("id") * 7).alias("k"))
    frame = spark.range(0, 2_100_000, 7).select(F.col("id").alias("k"), F.lit("x").alias("bits"), F.lit(1).alias("__at"))
    got = maybe_among(frame, keys, ["k"])
    assert got.columns == frame.columns and keys.join(got, "k", "left_anti").count() == 0
    rest = maybe_among(frame, keys, ["k"], others=True)
    assert got.count() + rest.count() == frame.count() and got.count() < 400 and rest.join(keys, "k").count() == 0
    assert maybe_among(frame, keys.where("k < 0"), ["k"]).count() == 0


def test_texts_without_dropped_lines_are_not_shuffled(spark, tmp_path):
    """Of a table with one repeated line, its own texts alone reach an exchange."""
    rng = random.Random(8)
    rows = [(i, "\n".join(" ".join(rng.choice(VOCABULARY) for _ in range(12)) for _ in range(3))) for i in range(400)]
    rows += [(400, rows[0][1].split("\n")[1]), (401, None)]
    spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3).write.parquet(str(tmp_path / "docs"))
    out = line_dedup(spark.read.parquet(str(tmp_path / "docs")), materialise=False)
    assert {r["doc_id"]: (r["text"] or "", r["n_lines"], r["n_dropped"]) for r in out.collect()} == {
        i: ("" if i >= 400 else t, 0 if t is None else len(t.split("\n")), int(i == 400)) for i, t in rows}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Union") == 1 and plan.count("SortMergeJoin") == 1 and plan.index("Union") < plan.index("SortMergeJoin")
