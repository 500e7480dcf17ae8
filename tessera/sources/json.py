"""JSON objects as key/value rows, and key/value rows as JSON objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def json_entries(df: DataFrame, json_col: str, keys: list[str],
                 key: str = "key", value: str = "value", reason: str | None = None) -> DataFrame:
    """One row per entry of a JSON object held in ``json_col``.

    Values are kept as text (numbers as their digits); of entries that repeat
    a key the last stays.  With ``reason``, a row without entries is kept too,
    with NULL key and value: ``no_text``, ``not_an_object`` or ``empty`` (entries
    have ``ok``); without, it yields nothing.
    """
    parsed = df.select(*keys, F.col(json_col).isNull().alias("_none"), F.from_json(F.col(json_col), "map<string,string>").alias("_m"))
    entries = F.map_entries("_m")
    names = F.map_keys("_m")
    # most objects repeat no key; only those that do are searched
    last = F.filter(entries, lambda e, i: F.array_position(F.slice(names, i + 2, F.size(names)), e["key"]) == 0)
    chosen = F.when(F.size(F.array_distinct(names)) == F.size(names), entries).otherwise(last)
    # outer form + NULL filter: a plain explode makes Catalyst infer a
    # size(map) > 0 filter and parse every JSON text twice
    rows = parsed.select(*keys, "_none", F.col("_m").isNull().alias("_bad"), F.explode_outer(chosen).alias("_e"))
    out = rows.select(*keys, F.col("_e.key").alias(key), F.col("_e.value").alias(value), "_none", "_bad", F.col("_e").isNull().alias("_no"))
    if reason is None:
        return out.where(~F.col("_no")).select(*keys, key, value)
    why = (F.when(F.col("_none"), "no_text").when(F.col("_bad"), "not_an_object")
           .when(F.col("_no"), "empty").otherwise("ok"))
    return out.select(*keys, key, value, why.alias(reason))


def read_json_object(spark: SparkSession, path: str, key: str = "key", value: str = "value", in_parts: bool = False) -> DataFrame:
    """The entries of the JSON object in each file (``json.load``), as key/value rows; with ``in_parts``,
    of the one object whose text is the files in name order (``write_json_object``).

    A file of any size is read in splits, cut at commas.  Of each stretch between two commas
    the scan notes its quotes and how it changes the depth of brackets,
    starting outside or inside a string.  A prefix sum over the stretches of a split, and one over splits, then tell
    which commas stand at depth one outside strings; the text between two of these is
    an entry, which is parsed by itself.  No task holds more than a split and an entry.

    A file whose brackets or quotes do not close, or that holds something else than an object, yields nothing, as does an entry that is not
    valid.  Of entries that repeat a key the last stays.
    """
    raw = spark.read.option("lineSep", ",").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.col("_metadata.file_size").alias("_size"),
        F.monotonically_increasing_id().alias("_row"), F.col("value").alias("_text"))
    raw = raw.withColumn("_object", F.lit("") if in_parts else F.col("_file"))
    bare = F.regexp_replace("_text", r"(?s)\\.", "")  # without escaped characters every quote opens or closes a string

    def depth(outside: Column) -> Column:
        return (F.length(F.regexp_replace(outside, r"[^{\[]", "")) - F.length(F.regexp_replace(outside, r"[^}\]]", ""))).cast("bigint")

    string = r'(?s)"[^"]*("|\z)'
    rows = raw.withColumn("_bare", bare).select(
        "_object", "_file", "_block", "_size", "_row", "_text", (F.length("_bare") - F.length(F.replace("_bare", F.lit('"')))).cast("bigint").alias("_q"),
        depth(F.regexp_replace("_bare", string, "")).alias("_d0"),
        depth(F.regexp_replace(F.regexp_replace("_bare", r'(?s)\A[^"]*("|\z)', ""), string, "")).alias("_d1"))

    split = ["_object", "_file", "_block"]
    inside = Window.partitionBy(*split).orderBy("_row")
    upto, below = (inside.rowsBetween(Window.unboundedPreceding, k) for k in (0, -1))

    def at(parity: int) -> Column:
        """Change of depth in the split up to and with this stretch, if the split starts outside (0) or inside (1) a string."""
        odd = (F.col("_before") + parity) % 2 == 1
        return F.sum(F.when(odd, F.col("_d1")).otherwise(F.col("_d0"))).over(upto)

    rows = rows.withColumn("_before", F.coalesce(F.sum("_q").over(below), F.lit(0)))
    rows = rows.withColumns({"_e0": at(0), "_e1": at(1)})
    splits = rows.groupBy(*split).agg(
        F.sum("_q").alias("_q"), F.max("_row").alias("_last"), F.max("_size").alias("_size"), F.sum(F.octet_length("_text") + 1).alias("_used"),
        F.sum(F.when(F.col("_before") % 2 == 1, F.col("_d1")).otherwise(F.col("_d0"))).alias("_t0"),
        F.sum(F.when(F.col("_before") % 2 == 0, F.col("_d1")).otherwise(F.col("_d0"))).alias("_t1"))
    of_file, of_object = Window.partitionBy("_object", "_file"), Window.partitionBy("_object")
    along = of_object.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    over = F.col("_size") - F.sum("_used").over(of_file)  # -1: no comma after the last stretch (3 more with a byte order mark)
    splits = splits.withColumns({
        "_parity": F.coalesce(F.sum("_q").over(along), F.lit(0)) % 2,
        "_open_end": F.when((F.col("_block") == F.max("_block").over(of_file)) & over.isin(-1, 2), F.col("_last"))})
    splits = splits.withColumn("_total", F.when(F.col("_parity") == 1, F.col("_t1")).otherwise(F.col("_t0")))
    closed = (F.sum("_total").over(of_object) == 0) & (F.sum("_q").over(of_object) % 2 == 0)
    splits = splits.withColumns({"_depth": F.coalesce(F.sum("_total").over(along), F.lit(0)), "_closed": closed})
    known = rows.join(splits.where("_closed").select(*split, "_parity", "_depth", "_open_end"), split)
    depth_after = F.col("_depth") + F.when(F.col("_parity") == 1, F.col("_e1")).otherwise(F.col("_e0"))
    comma = F.coalesce(F.col("_row") != F.col("_open_end"), F.lit(True))
    ends = comma & ((F.col("_parity") + F.col("_before") + F.col("_q")) % 2 == 0) & (depth_after == 1)
    marked = known.select(*split, "_row", F.when(comma, F.concat("_text", F.lit(","))).otherwise(F.col("_text")).alias("_text"), ends.cast("int").alias("_ends"))
    marked = marked.withColumn("_local", F.coalesce(F.sum("_ends").over(below), F.lit(0)))
    counts = marked.groupBy(*split).agg(F.sum("_ends").alias("_n")).withColumn("_first", F.coalesce(F.sum("_n").over(along), F.lit(0)))
    parts = marked.join(counts.select(*split, "_first"), split)
    pieces = F.array_sort(F.collect_list(F.struct("_file", "_block", "_row", "_text")))
    entries = parts.groupBy("_object", (F.col("_first") + F.col("_local")).alias("_entry")).agg(
        F.array_join(F.transform(pieces, lambda p: p["_text"]), "").alias("_text"))
    # the first entry opens the object, the last closes it, all others end with their comma
    body = F.when(F.col("_entry") == F.col("_n"), F.regexp_replace("_text", r"\}\s*\z", "")).otherwise(F.regexp_replace("_text", r",\z", ""))
    final = counts.groupBy("_object").agg(F.sum("_n").alias("_n"))
    entries = entries.join(final, "_object").select("_object", "_entry", F.when(F.col("_entry") == 0, F.regexp_replace(body, r"\A\s*\{", "")).otherwise(body).alias("_body"),
                                                     (F.col("_entry") > 0).alias("_later"), F.col("_text").rlike(r"\A\s*\{").alias("_opens"))
    entries = entries.where("_later or _opens").withColumn("_json", F.concat(F.lit("{"), "_body", F.lit("}")))
    found = json_entries(entries, "_json", ["_object", "_entry"], "_k", "_v")
    newest = found.groupBy("_object", "_k").agg(F.max("_entry").alias("_entry"))
    return found.join(newest, ["_object", "_k", "_entry"], "left_semi").select(F.col("_k").alias(key), F.col("_v").alias(value))


def write_json_object(df: DataFrame, key: str, value: str, path: str, order_by: str | None = None) -> None:
    """One JSON object of all rows, replacing what is at ``path``: a folder of
    files whose text in name order is the object, one entry a line.

    Entries are in the order of ``order_by`` (the key, if not given), which must differ between
    rows; rows without a key are left out, as an object has none.  Rows are
    sorted by range partitions, so no task holds more than its share; the opening bracket, the separators and the closing one are rows (or parts of
    rows) themselves.  Spark commits all files at once; a task that ran twice leaves one.
    """
    order = F.col(order_by or key)
    entry = F.to_json(F.map_from_arrays(F.array(F.col(key).cast("string")), F.array(value)), {"ignoreNullFields": "false"})
    rows = df.where(F.col(key).isNotNull()).select(F.lit(1).alias("_band"), order.alias("_o"), F.substring(entry, 2, F.length(entry) - 2).alias("_line"))
    head = rows.orderBy("_o").limit(1).select("_o").collect()  # the one entry without a comma before it
    if head:
        comma = F.when(F.col("_o").eqNullSafe(F.lit(head[0][0]).cast(rows.schema["_o"].dataType)), "").otherwise(",")
        rows = rows.withColumn("_line", F.concat(comma, "_line"))
    none = F.lit(None).cast(rows.schema["_o"].dataType)
    spark = df.sparkSession
    edges = spark.range(2).select(F.when(F.col("id") == 0, 0).otherwise(2).alias("_band"), none.alias("_o"), F.when(F.col("id") == 0, "{").otherwise("}").alias("_line"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.unionByName(edges).repartitionByRange(n, "_band", "_o").sortWithinPartitions("_band", "_o")
    ordered.select(F.col("_line").alias("value")).write.mode("overwrite").text(path)


def read_json_objects(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """A file of JSON lines, one object each, as key/value rows."""
    raw = spark.read.text(path).withColumn("_line", F.monotonically_increasing_id())
    return json_entries(raw, "value", ["_line"], key, value).drop("_line")


def entries_to_json(df: DataFrame, group: list[str], key: str, value: str, out: str = "json",
                    style: str = "compact", order_by: str | None = None) -> DataFrame:
    """One JSON object per group.

    ``style="compact"`` is Spark's ``to_json`` (``{"a":1}``); ``"python"`` is
    ``json.dumps`` with its default separators (``{"a": 1, "b": 2}``), each key
    and value escaped by ``to_json`` (non-ASCII text is kept as it is, as with
    ``ensure_ascii=False``; very large or small doubles use Spark's number
    format).  Entries are in key order, or in the
    order of ``order_by`` (e.g. a position column, as a dict keeps insertion
    order).  The object is built per group, so a group must be small enough
    to be one value (a dimension, not a fact table); one object of any
    number of rows is written by ``write_json_object``.
    """
    sort_key = F.col(order_by) if order_by is not None else F.col(key).cast("string")
    entry = F.struct(sort_key.alias("o"), F.col(key).cast("string").alias("k"), F.col(value).alias("v"))
    entries = F.array_sort(F.collect_list(entry))
    if style == "compact":
        pairs = F.transform(entries, lambda e: F.struct(e["k"].alias("k"), e["v"].alias("v")))
        text = F.to_json(F.map_from_entries(pairs))
    elif style == "python":
        def scalar(c):  # JSON text of one value: to_json of a one-element array, brackets removed
            js = F.to_json(F.array(c))
            return F.substring(js, 2, F.length(js) - 2)
        items = F.transform(entries, lambda e: F.concat(scalar(e["k"]), F.lit(": "), scalar(e["v"])))
        text = F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))
    else:
        raise ValueError(f"unknown style {style!r}")
    return df.groupBy(*group).agg(text.alias(out))


def write_json_lines(df: DataFrame, path: str) -> None:
    """One JSON object per row, replacing what is at ``path``."""
    df.write.mode("overwrite").json(path)
