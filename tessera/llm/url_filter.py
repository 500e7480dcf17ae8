"""URL rules by a sort-merge range join.

A rule (host, path) holds for its host, all subdomains, and every path that
starts with its own.  Under the key "host labels from the right, then path" a
rule becomes the interval of keys that start with its key.  Each URL asks once
for each suffix of its host; rules and questions are sorted together by
range, and one sweep per partition keeps the stack of rules whose interval is
open.  What is open where a partition begins follows from that partition's
first key alone: the rules that are prefixes of it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._common import col, ship, stored, without

#: Ends the host part of a key; sorts below every character of a host or path.
_END = "\x00"
#: A rule is packed as its length, times this, plus twice its number of labels (and one if it allows).
_LABELS = 1 << 24
RULE = T.StructType([T.StructField(n, T.StringType()) for n in ("host", "path", "verdict")])


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://`` or for null."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty as for the host."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def rules_frame(spark, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (host, path, allow | block)."""
    return spark.createDataFrame(list(rules), RULE)


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               partitions: int | None = None) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``.

    The longest rule that fits decides: most characters of host and path, then
    most host labels; a pair given with both verdicts blocks.  Where none fits,
    ``rule`` is null and ``verdict`` is ``default``.  Null, empty and
    scheme-less URLs have an empty host, which no rule fits; rules without a
    host, a path (which starts with ``/``) or a known verdict are ignored; repeated rows are judged
    each; empty tables give an empty result; input columns named like a result
    column give way to it.

    URLs of any length and hosts of any number of labels are asked about up to the longest
    rule key and the deepest rule host only, which loses nothing.

    Rules and pages may both be large: both are shuffled once by key range.
    Equal keys are dealt out by a random second key, so one hot URL or host
    spreads.  The only thing that reaches the driver is each partition's first
    key and the rules that are prefixes of it (partitions times key depth).
    """
    spark = pages.sparkSession
    ship(spark)
    keep = without(pages, ["host", "path", "rule", "verdict"])
    url = col(url_col)
    base = stored(pages.select(*[col(c) for c in keep], url_host(url).alias("host"), url_path(url).alias("path"),
                               F.monotonically_increasing_id().alias("__rid")), "url-pages")

    rule = (rules.select(lower_ascii(F.col("host")).alias("host"), F.col("path"), F.col("verdict"))
            .where("host <> '' and path like '/%' and verdict in ('allow', 'block')")
            .groupBy("host", "path").agg(F.min(F.col("verdict") == "allow").alias("allow")))
    size = F.length("host") + F.length("path")
    rule = rule.select(F.concat(_reversed(F.col("host")), F.lit(_END), F.col("path")).alias("key"),
                       F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("salt"),
                       (size.cast("bigint") * _LABELS + F.size(F.split("host", r"\.")) * 2 + F.col("allow").cast("int")).alias("rid"))
    # beyond the longest rule key and the deepest rule host nothing of a URL is asked about
    longest, deepest = rule.agg(F.max(F.length("key")), F.max(F.shiftright(F.col("rid") % _LABELS, 1))).first()
    longest, deepest = longest or 0, int(deepest or 0)

    labels = F.reverse(F.split("host", r"\."))
    ask = (base.where("host <> ''").select("__rid", "path", labels.alias("labels"))
           .select("__rid", F.left("path", F.lit(longest)).alias("path"), F.slice("labels", 1, max(deepest, 1)).alias("labels"))
           .select("__rid", "path", "labels", F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"))
           .select(F.left(F.concat(F.array_join(F.slice("labels", 1, F.col("n")), "."), F.lit(_END), F.col("path")), F.lit(longest)).alias("key"),
                   F.lit(1).alias("kind"), F.xxhash64("__rid").alias("salt"), F.col("__rid").alias("rid")))
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # stored with its partition number: both sweeps must see the same cuts
    line = stored(rule.unionByName(ask).repartitionByRange(n, "key", "kind", "salt")
                  .withColumn("part", F.spark_partition_id()), "url-line")

    starts = line.groupBy("part").agg(F.min("key").alias("first"))
    prefixes = starts.select("part", F.explode(F.expr("transform(sequence(1, length(first)), i -> left(first, i))")).alias("key"))  # at most `longest` of them
    seeds: dict[int, list[tuple[str, int]]] = {}
    for part, key, rid in rule.join(prefixes, "key").select("part", "key", "rid").collect():
        seeds.setdefault(part, []).append((key, rid))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, stack = None, []
        for batch in batches:
            hits, packed = [], []
            for p, key, kind, rid in zip(*(batch.column(c).to_pylist() for c in ("part", "key", "kind", "rid")), strict=True):
                if p != part:
                    part, stack = p, sorted(seeds.get(p, ()))
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if kind == 0:
                    stack.append((key, rid))
                elif stack:
                    hits.append(rid)
                    packed.append(stack[-1][1])
            yield pa.RecordBatch.from_arrays([pa.array(hits, pa.int64()), pa.array(packed, pa.int64())], names=["__rid", "best"])

    swept = (line.repartition(n, "part").sortWithinPartitions("part", "key", "kind")
             .mapInArrow(sweep, "__rid bigint, best bigint"))
    best = swept.groupBy("__rid").agg(F.max("best").alias("best"))
    out = base.join(best, "__rid", "left")
    # length and label count say which part of the URL itself the rule is
    suffix = F.expr(f"substring_index(host, '.', -cast(shiftright(best % {_LABELS}, 1) as int))")
    length = F.call_function("div", F.col("best"), F.lit(_LABELS)).cast("int") - F.length(suffix)
    return out.select(
        *[col(c) for c in keep], "host", "path",
        F.when(F.col("best").isNotNull(), F.concat(suffix, F.left(F.col("path"), length))).alias("rule"),
        F.when(F.col("best").isNull(), F.lit(default)).when(F.col("best").bitwiseAND(1) == 1, "allow").otherwise("block").alias("verdict"))
