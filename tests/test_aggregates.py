import random
from conftest import rows
from fixtures import BOARDS, DUPS, names_lines
from pyspark.sql import functions as F

from tessera.operators import aggregates as agg


def test_names_counts_and_first_seen_order(spark):
    names = spark.createDataFrame([(i + 1, n) for i, n in enumerate(names_lines())], "line_no long, name string")
    out = agg.value_counts(names, "name", ["line_no"])
    got = [(r["name"], r["n"]) for r in out.orderBy("first_line_no").collect()]
    assert got == [("Darthk", 1), ("Luke", 15), ("Darth", 30), ("Lea", 54)]


def test_occurrence_split(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(DUPS)], "pos int, v long")
    out = agg.occurrence_split(df, ["v"])
    repeated = sorted(r["v"] for r in out.where(F.col("kind") == "repeated").collect())
    single = sorted(r["v"] for r in out.where(F.col("kind") == "single").collect())
    assert repeated == [2, 2, 10, 10]
    assert single == [1, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13]


def test_first_seen_distinct_order(spark):
    df = spark.createDataFrame([(0, i, v) for i, v in enumerate(DUPS)], "g int, pos int, v long")
    out = agg.first_seen_distinct(df, ["g"], "v", ["pos"])
    assert [r["v"] for r in out.orderBy("seen_rank").collect()] == list(range(1, 14))
    # the segmented form (the group counts as hot above 5 values) gives the same ranks
    seg = agg.first_seen_distinct(df, ["g"], "v", ["pos"], chunk_rows=5)
    assert rows(seg, "v", "seen_rank") == rows(out, "v", "seen_rank")


def test_value_counts_rank(spark):
    names = spark.createDataFrame([(i + 1, n) for i, n in enumerate(names_lines())], "line_no long, name string")
    out = agg.value_counts(names, "name", ["line_no"], rank="first_seen_rank")
    assert rows(out, "first_seen_rank", "name") == [(1, "Darthk"), (2, "Luke"), (3, "Darth"), (4, "Lea")]


def test_board_lines(spark):
    cells = [(b, r, c, v) for b, board in enumerate(BOARDS, 1) for r, row in enumerate(board)
             for c, v in enumerate(row)]
    df = spark.createDataFrame(cells, "board int, r int, c int, v int")
    got = rows(agg.board_lines(df, ["board"], "r", "c", "v", 4), "board", "kind", "line", "winner")
    assert got == [(1, "diag", 0, 1), (2, "col", 0, 2), (2, "diag", 0, 2)]


def test_board_outcomes(spark):
    cells = [(b, r, c, v) for b, board in enumerate(BOARDS, 1) for r, row in enumerate(board)
             for c, v in enumerate(row)]
    df = spark.createDataFrame(cells, "board int, r int, c int, v int")
    got = rows(agg.board_outcomes(df, ["board"], "r", "c", "v", 4), "board", "has_line", "winner")
    assert got == [(1, True, 1), (2, True, 2), (3, False, None)]


def test_board_lines_transposed_is_same(spark):
    cells = [(b, r, c, v) for b, board in enumerate(BOARDS, 1) for r, row in enumerate(board)
             for c, v in enumerate(row)]
    df = spark.createDataFrame(cells, "board int, r int, c int, v int")
    t = df.select("board", F.col("c").alias("r"), F.col("r").alias("c"), "v")
    swap = {"row": "col", "col": "row", "diag": "diag", "anti": "anti"}
    a = rows(agg.board_lines(df, ["board"], "r", "c", "v", 4), "board", "kind", "winner")
    b = rows(agg.board_lines(t, ["board"], "r", "c", "v", 4), "board", "kind", "winner")
    assert sorted((x, swap[k], w) for x, k, w in b) == a


def test_uniform_groups(spark):
    df = spark.createDataFrame([(1, "h1", "a"), (1, "h1", "a"), (1, "h2", "b"), (2, "h1", "c"), (2, "h1", "c")],
                               "u int, h string, t string")
    got = rows(agg.uniform_groups(df, [["u"], ["u", "h"]], "t"), "u", "h", "level", "t", "n")
    assert got == [(1, "h1", 0, "a", 2), (2, "h1", 0, "c", 2), (2, None, 1, "c", 2)]


def test_pivot_counts(spark):
    df = spark.createDataFrame([("x", 0), ("x", 0), ("x", 2), ("y", 1)], "k string, d int")
    got = rows(agg.pivot_counts(df, "k", "d", [0, 1, 2], ["a", "b", "c"]), "k", "a", "b", "c")
    assert got == [("x", 2, 0, 1), ("y", 0, 1, 0)]


def test_sliced_counts(spark):
    lines = [f"AB {cat}" + "-" * 25 for cat in ["cat1", "cat2", "cat1", "cat3", "cat1"]] + ["short"]
    df = spark.createDataFrame([(s,) for s in lines], "s string")
    got = dict(rows(agg.sliced_counts(df, "s", 3, 25), "key", "n"))
    assert got == {"cat1": 3, "cat2": 1, "cat3": 1, "": 1}


def test_max_per_key_and_count_matching(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", 7.5), ("b", None)], "k string, v double")
    assert rows(agg.max_per_key(df, ["k"], "v")) == [("a", 7.5), ("b", None)]
    assert rows(agg.count_matching(df, ["k"], F.col("v") > 5)) == [("a", 1), ("b", 0)]


def test_first_seen_distinct_segmented_on_timestamps(spark):
    from conftest import SF01
    # distinct values per event type ranked by first appearance; every group
    # has more than 50 distinct users, so all groups are cut into chunks
    e = spark.read.parquet(f"{SF01}/events.parquet")
    plain = agg.first_seen_distinct(e, ["event_type"], "user_id", ["ts", "event_id"])
    seg = agg.first_seen_distinct(e, ["event_type"], "user_id", ["ts", "event_id"], chunk_rows=50)
    assert rows(seg, "event_type", "user_id", "seen_rank") == rows(plain, "event_type", "user_id", "seen_rank")


def test_board_lines_of_boards_kept_as_arrays(spark):
    rng = random.Random(5)
    cells = [(b, r, c, rng.choice([0, 1, 1, 1, 2])) for b in range(300) for r in range(3) for c in range(3) if rng.random() < 0.9]
    df = spark.createDataFrame(cells, "board int, r int, c int, v bigint")
    boards = df.groupBy("board").agg(F.collect_list(F.struct("r", "c", "v")).alias("cells"))
    want = rows(agg.board_lines(df, ["board"], "r", "c", "v", 3), "board", "kind", "line", "winner")
    out = agg.board_lines(boards, ["board"], "r", "c", "v", 3, cells_col="cells")
    assert rows(out, "board", "kind", "line", "winner") == want and len({w[1:3] for w in want}) == 8
    from tessera.plans.registry import QUERIES

    plan = QUERIES["matrix_lines"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("HashAggregate") == 2  # the boards', partial and final: no aggregate of tagged cells
