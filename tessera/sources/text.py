"""Line-shaped inputs: text files and text columns as one row per line.

Order matters for the reference (files are lists), so every line carries
its position.  Lines of a text *column* are numbered by ``posexplode``
inside the row; lines of text *files* get their number from the file split
they were read from plus a per-split offset, so no file ever passes through
a single task (a stretch without a line feed is one value).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.numbers import parse_int
from tessera.functions.strings import py_strip, split_lines


def lines_of(df: DataFrame, text_col: str, keys: list[str],
             line_no: str = "line_no", line: str = "line") -> DataFrame:
    """One row per line of ``text_col``: ``keys + [line_no (1-based), line]``."""
    # the outer form plus a NULL filter: for a plain posexplode Catalyst infers
    # a size(array) > 0 filter and evaluates the split a second time
    exploded = (df.select(*keys, F.posexplode_outer(split_lines(F.col(text_col))).alias("_pos", line))
                .where(F.col("_pos").isNotNull()))
    return exploded.select(*keys, (F.col("_pos") + 1).cast("bigint").alias(line_no), line)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as ``(file, line_no, line)``: the lines and 1-based numbers of
    Python's ``open(file).read().splitlines()``.

    Files are read in splits at line feeds; the other line ends (``\\r``, vertical tab,
    form feed, U+001C to U+001E, U+0085, U+2028, U+2029) cut the lines inside what stands between two
    of them.  ``monotonically_increasing_id`` numbers the lines inside the
    task that reads a split in order, and a prefix sum over splits gives each split its
    offset.  Whether a file ends with a line feed follows from its size (the sum
    over its lines), as does a byte order mark, which is given back.  Of a
    compressed file, whose size says nothing, a last line feed is taken for granted.
    """
    read = (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
                    F.col("_metadata.file_size").alias("_size"), F.octet_length("value").cast("bigint").alias("_bytes"),
                    split_lines(F.concat("value", F.lit("\n"))).alias("_lines")))
    raw = (read.select("file", "_block", "_size", "_bytes", F.size("_lines").alias("_many"), F.posexplode_outer("_lines").alias("_pos", "line"))
           .withColumn("_row", F.monotonically_increasing_id()))
    # in a file without a last line feed, a line that only that line feed would end
    open_end = (F.col("_pos") > 0) & (F.col("_pos") == F.col("_many") - 1) & (F.col("line") == "")
    raw = raw.select("file", "_block", "_size", "_row", "line", F.when(F.col("_pos") == 0, F.col("_bytes") + 1).alias("_used"), open_end.alias("_open"))
    splits = raw.groupBy("file", "_block").agg(
        F.count("*").alias("_n"), F.min("_row").alias("_first"), F.max("_row").alias("_last"), F.sum("_used").alias("_used"), F.max("_size").alias("_size"))
    whole = Window.partitionBy("file")
    before = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    over = F.col("_size") - F.sum("_used").over(whole)  # 0; 1 less without a last line feed; 3 more with a byte order mark
    splits = splits.select(
        "file", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
        F.when((F.col("_block") == F.max("_block").over(whole)) & over.isin(-1, 2), F.col("_last")).alias("_cut"),
        F.when((F.col("_block") == F.min("_block").over(whole)) & over.isin(2, 3), F.col("_first")).alias("_mark"))
    # one row per split: Spark broadcasts it where it is small
    joined = raw.join(splits, ["file", "_block"]).where(~(F.col("_open") & F.coalesce(F.col("_row") == F.col("_cut"), F.lit(False))))
    marked = F.when(F.col("_row") == F.col("_mark"), F.concat(F.lit("\ufeff"), F.col("line"))).otherwise(F.col("line"))
    return joined.select("file", (F.col("_offset") + F.col("_row") - F.col("_first") + 1).cast("bigint").alias("line_no"), marked.alias("line"))


def typed_lines(df: DataFrame, value_col: str, out: str = "value", strict: bool = True) -> DataFrame:
    """Lines to integers, surrounding blanks tolerated.

    ``strict``: a bad line fails the job, as ``int(line)`` raises;
    otherwise the value is NULL and ``is_valid`` is false.
    """
    text = F.col(value_col)
    value = parse_int(text)
    if strict:
        bad = text.isNotNull() & value.isNull()
        message = F.concat(F.lit("not an integer: "), text)
        return df.withColumn(out, F.when(bad, F.raise_error(message)).otherwise(value))
    return df.withColumn(out, value).withColumn("is_valid", value.isNotNull())


def word_list(df: DataFrame, text_col: str, keys: list[str], word: str = "word") -> DataFrame:
    """Lines of a word list, stripped, with ``before_blank``.

    ``before_blank`` is true for the lines before the first blank line of
    their text (the reader that stops at the first empty line keeps exactly
    those).  Blank lines are dropped from the list itself.  The first blank
    is found inside the row with array functions: no window, no shuffle.
    """
    words = F.transform(split_lines(F.col(text_col)), py_strip)
    # the array is built once in its own projection; used twice in the same
    # projection as the generator, it would be rebuilt for every output row
    staged = (df.select(*keys, words.alias("_w"))
              .select(*keys, F.array_position("_w", "").alias("_blank"), "_w"))
    # outer form + NULL filter: a plain posexplode makes Catalyst infer a
    # size(array) > 0 filter below the projection, computing the array twice
    exploded = (staged.select(*keys, "_blank", F.posexplode_outer("_w").alias("_pos", word))
                .where(F.col("_pos").isNotNull()))
    line_no = (F.col("_pos") + 1).cast("bigint")
    return (exploded.where(F.col(word) != "")
            .select(*keys, line_no.alias("line_no"), word,
                    ((F.col("_blank") == 0) | (line_no < F.col("_blank"))).alias("before_blank")))


def word_list_of_lines(lines: DataFrame, keys: list[str], line_no: str = "line_no", line: str = "line",
                       word: str = "word") -> DataFrame:
    """``word_list`` for a table of lines (e.g. ``read_lines`` of word files).

    The first blank line per file comes from a partial ``min`` aggregate
    joined back, so a file of any length is spread over many tasks.
    """
    stripped = lines.withColumn(word, py_strip(F.col(line)))
    blanks = (stripped.where(F.col(word) == "").groupBy(*keys)
              .agg(F.min(line_no).alias("_blank")))
    kept = stripped.where(F.col(word) != "").join(blanks, keys, "left")
    before = F.col("_blank").isNull() | (F.col(line_no) < F.col("_blank"))
    return kept.select(*keys, line_no, word, before.alias("before_blank"))


def write_text(df: DataFrame, column: str | Column, path: str) -> None:
    """Write one string column as text files, replacing what is there."""
    col = F.col(column) if isinstance(column, str) else column
    df.select(col.alias("value")).write.mode("overwrite").text(path)
