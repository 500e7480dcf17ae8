"""Language identification by Bayesian fusion of evidence.

Four kinds of evidence about a document's language are multiplied: how likely
its text is under each language (byte trigrams), the language its markup or
metadata declares, the suffix of its address, and what its host usually
carries.  How far a declaration or a suffix can be trusted is counted over all
documents; a host's prior is smoothed towards its domain's, that towards its
suffix's, and that towards the whole corpus's.  One more hypothesis, bytes in
no order, stands for "no language"; another, open to documents that declare a
language without labels, stands for that language.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm._common import col, map_arrow, ship, stored, text_slices

BUCKETS = 1 << 15
UNKNOWN = "und"
#: Share of the trigrams' log likelihood that counts: neighbouring trigrams overlap.
TEMPER = 0.2
#: Prior of "no language": only texts that are disorder through and through pass it.
UNKNOWN_PRIOR = 1e-9
# A-Z lower-cased; digits, marks and white space all as one space
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[b for b in range(128) if not 97 <= _LOWER[b] <= 122]] = 32


def markup_language(html: Column) -> Column:
    """Primary language a page's ``<html lang=...>`` declares, lower-cased; null if none."""
    found = F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", 1))
    return F.when(found != "", found)


def address_host(url: Column) -> Column:
    """Lower-cased host name of a URL, without user and port; null if none."""
    found = F.lower(F.regexp_extract(url, r"(?s)^[^/?#]*?://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(found != "", found)


def trigram_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that begins at each byte but the last two;
    ``BUCKETS``, which counts for nothing, if two of its bytes are no letters."""
    low = _LOWER[data]
    x, blank = low.astype(np.uint32), (low == 32).astype(np.uint8)
    found = ((x[:-2] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[2:] * np.uint32(0xC2B2AE3D))
             * np.uint32(0x27D4EB2F) >> np.uint32(17)).astype(np.int32)
    found[blank[:-2] + blank[1:-1] + blank[2:] > 1] = BUCKETS
    return found


@functools.cache
def _scripts() -> tuple[np.ndarray, int]:
    """Number of each code point's script (0: no letter), the first word of a
    letter's name, and how many numbers there are."""
    names = {i: unicodedata.name(chr(i), "").split(" ")[0] for i in range(0x110000) if unicodedata.category(chr(i))[0] == "L"}
    number = {v: k for k, v in enumerate(sorted(set(names.values())), 1)}
    out = np.zeros(0x110000, np.int16)
    out[list(names)] = [number[v] for v in names.values()]
    return out, len(number) + 1


def letter_scripts(data: np.ndarray) -> np.ndarray:
    """Script number of the letter that begins at each byte of UTF-8; 0 where none does."""
    script, _ = _scripts()
    out = np.where(data < 128, script[:128][data & 127], np.int16(0))
    more = np.concatenate([data, np.zeros(3, np.uint8)])
    for low, high, tail in ((0xC2, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0xF5, 3)):
        at = np.flatnonzero((data >= low) & (data < high))
        point = (data[at] & (0x3F >> tail)).astype(np.int32)
        for k in range(1, tail + 1):
            point = point << 6 | more[at + k] & 63
        out[at] = script[np.minimum(point, 0x10FFFF)]
    return out


def _unordered(byte_counts: np.ndarray) -> np.ndarray:
    """Bucket probabilities of three bytes drawn independently."""
    p = (byte_counts + 1e-3) / (byte_counts + 1e-3).sum()
    out = np.zeros(BUCKETS)
    second = np.tile(np.arange(256, dtype=np.uint8)[:, None], (1, 256)).reshape(-1)
    third = np.tile(np.arange(256, dtype=np.uint8), 256)
    for b in range(256):
        triples = np.stack([np.full(65536, b, np.uint8), second, third], axis=1).reshape(-1)
        out += np.bincount(trigram_buckets(triples)[::3], p[b] * np.outer(p, p).reshape(-1), BUCKETS + 1)[:BUCKETS]
    return out / out.sum()


def hash_bound(wanted: int, texts: int) -> int:
    """A 64-bit hash below which more than ``wanted`` of about ``texts``
    (counted within a fifth) different texts surely lie; all, if they are few."""
    share = 2.5 * (wanted + 100) / max(texts, 1)
    return (1 << 63) - 1 if share >= 1 else int(share * (1 << 64)) - (1 << 63)


def fit_text_model(docs: DataFrame, label: Column, text_col: str = "text", train_rows: int = 400) -> tuple[list[str], np.ndarray]:
    """Languages and (BUCKETS + 1 + scripts, languages + 1) numbers: log
    likelihoods, the last column for bytes in no order; a row of zeros (no
    trigram); and a row for each script, 1 for the languages written in it.

    Every label is a language, the one with most rows first.  Fitted on at most
    ``train_rows`` labelled rows a language (those of smallest text hash) and
    smoothed towards all languages' trigrams, which a language of few rows
    nearly equals; null, empty and unknown labels are not used.
    """
    spark = docs.sparkSession
    n_scripts = _scripts()[1]
    rows = docs.select(label.alias("label"), col(text_col).alias("text"))
    known = rows.where(F.col("label").isNotNull() & ~F.col("label").isin("", UNKNOWN) & (F.length("text") > 0))
    texts = F.approx_count_distinct(F.xxhash64("text"))
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("n"), texts.alias("texts")).orderBy(F.desc("n"), "label").collect()
    languages = [r["label"] for r in sizes]
    if not languages:
        return [], np.zeros((BUCKETS + 1 + n_scripts, 1), np.float32)
    ship(spark)
    rank = F.row_number().over(Window.partitionBy("label").orderBy("h"))
    # hashes below a bound that about 2.5 times the wanted texts of a language pass: all that can be among the smallest
    bounds = spark.createDataFrame([(r["label"], hash_bound(train_rows, r["texts"])) for r in sizes],
                                   T.StructType([known.schema["label"], T.StructField("bound", T.LongType())]))
    keyed = known.select("label", F.xxhash64("text").alias("h")).join(F.broadcast(bounds), "label").where("h <= bound").drop("bound")
    chosen = keyed.distinct().withColumn("r", rank).where(F.col("r") <= train_rows).groupBy("label").agg(F.max("h").alias("last"))
    train = (known.join(F.broadcast(chosen), "label")  # one row a language
             .where(F.xxhash64("text") <= F.col("last")).dropDuplicates(["label", "text"]).select("label", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, grams, single, letters = None, None, None, None

        def counted() -> pa.RecordBatch:
            at = np.flatnonzero(grams)
            lists = [pa.array([v.tolist()], pa.list_(pa.int64())) for v in (at, grams[at], single, letters)]
            return pa.RecordBatch.from_arrays([pa.array([own]), *lists], names=["label", "at", "grams", "bytes", "letters"])

        for batch in batches:
            labels = batch.column(0).to_pylist()
            for first, _, data, offsets in text_slices(batch.column(1)):
                for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                    if labels[first + k] != own:  # rows come label after label
                        if own is not None:
                            yield counted()
                        own = labels[first + k]
                        grams, single, letters = (np.zeros(n, np.int64) for n in (BUCKETS, 256, n_scripts))
                    single += np.bincount(_LOWER[data[a:b]], minlength=256)
                    letters += np.bincount(letter_scripts(data[a:b]), minlength=n_scripts)
                    if b - a >= 3:
                        grams += np.bincount(trigram_buckets(data[a:b]), minlength=BUCKETS + 1)[:BUCKETS]
        if own is not None:
            yield counted()

    grams = np.zeros((BUCKETS, len(languages)))
    single = np.zeros(256)
    table = np.zeros((BUCKETS + 1 + n_scripts, len(languages) + 1), np.float32)
    at = {v: k for k, v in enumerate(languages)}
    # at most 16 rows a language, each with the counts of the buckets that occur in one share of its texts
    share = F.pmod(F.xxhash64("text"), F.lit(16))
    dealt = train.repartition(4 + len(languages) // 16, "label", share).sortWithinPartitions("label")
    for row in dealt.mapInArrow(count, "label string, at array<bigint>, grams array<bigint>, bytes array<bigint>, "
                                       "letters array<bigint>").toLocalIterator():
        k = at[row["label"]]
        grams[row["at"], k] += np.array(row["grams"], float)
        single += np.array(row["bytes"])
        table[BUCKETS + 2:, k] += np.array(row["letters"][1:]) > 0
    table = np.minimum(table, 1)
    pooled = (grams.sum(1) + 0.01) / (grams.sum() + 0.01 * BUCKETS)
    size = grams.sum(0)
    grams += 200 * pooled[:, None]
    grams /= size + 200
    table[:BUCKETS, :-1] = np.log(np.maximum(grams, 1e-12, out=grams), out=grams)
    table[:BUCKETS, -1] = np.log(np.maximum(_unordered(single), 1e-12))
    return languages, table


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: Column | None = None,
                url: Column | None = None, host: Column | None = None, label: Column | None = None,
                smoothing: float = 20.0, carry: tuple[str, ...] = (), model: tuple[list[str], np.ndarray] | None = None) -> DataFrame:
    """One narrow row per document: ``rid, doc_id, language, probability, kept``.

    ``declared`` is the language stated by markup or metadata, ``url`` the address
    (its suffix and host are evidence), ``host`` another name for the origin,
    ``label`` the labels the text model is fitted on (``declared`` if not given).
    Each kind of evidence that is null or not given for a row says nothing.

    ``kept`` is false only for documents in which no language can be told: null,
    empty and letterless texts (language ``und``, probability 1) and
    those that bytes in no order explain better than any known language; and, if
    no language has labels, for all rows without declaration.  A wrong
    declaration is outvoted, not rejected.  A declared language that has no
    labels counts as known: its texts are held to be like all languages and
    no language mixed, and are not rejected.  Where most letters are of scripts in which no labelled text
    is written, the text says nothing of the known languages: the document is
    kept, in its declared language or ``und``, with probability 1.  Repeated rows and ties are judged each alike (ties go to the more frequent label); an
    empty table gives an empty result.  ``rid`` numbers the input rows as
    ``monotonically_increasing_id`` does on a plain scan.

    Shuffles carry narrow rows only: counts per (language, declaration), per
    suffix and per host are partial aggregates, and a frequent host joins as any
    skewed key does.
    """
    spark = docs.sparkSession
    ship(spark)
    nothing = F.lit(None).cast("string")
    declared = nothing if declared is None else F.lower(declared)
    address = nothing if url is None else address_host(url)
    origin = F.coalesce(host if host is not None else nothing, address)
    languages, table = model or fit_text_model(docs, declared if label is None else label, text_col)
    n_lang = len(languages)
    claim = F.when(~F.col("__declared").isin("", UNKNOWN), F.col("__declared"))
    frame = docs.select(F.monotonically_increasing_id().alias("rid"), col(id_col).alias("doc_id"), *[col(c) for c in carry],
                        declared.alias("__declared"), origin.alias("__host"), address.alias("__address"),
                        F.coalesce(col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("__letters"), col(text_col).alias("__text"))
    shared = spark.sparkContext.broadcast(table)  # BUCKETS x (languages + 1), whatever the corpus's rows

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = shared.value
        width = model_.shape[1] + 1
        columns = [model_[:BUCKETS + 1, k] for k in range(width - 1)]
        # any language: all columns mixed
        columns.append(functools.reduce(np.logaddexp, columns) - np.float32(np.log(width - 1)))
        columns[-1][BUCKETS] = 0
        strange = np.zeros(_scripts()[1], bool)  # scripts without labelled text
        strange[1:] = n_lang > 0 and len(model_) > BUCKETS + 1 and ~(model_[BUCKETS + 2:] > 0).any(axis=1)
        for batch in batches:
            for first, end, data, offsets in text_slices(batch.column(batch.num_columns - 1)):
                out = np.zeros((end - first, width))
                script = letter_scripts(data)
                odd, every = (np.concatenate([[0], np.cumsum(v)])[offsets] for v in (strange[script], script > 0))
                foreign = 2 * np.diff(odd) > np.diff(every)
                if len(data) >= 3:
                    grams = trigram_buckets(data)
                    a = np.minimum(offsets[:-1], len(grams))
                    b = np.minimum(np.maximum(offsets[1:] - 2, offsets[:-1]), len(grams))
                    for k, one in enumerate(columns):
                        total = np.concatenate([[0.0], np.cumsum(one[grams], dtype=np.float64)])
                        out[:, k] = total[b] - total[a]
                part = batch.slice(first, end - first)
                lists = pa.ListArray.from_arrays(np.arange(0, out.size + 1, out.shape[1], dtype=np.int32), pa.array(out.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, pa.array(foreign)],
                                                 names=[*part.schema.names[:-1], "__text", "__foreign"])

    kinds = T.StructType([*frame.schema.fields[:-1], T.StructField("__text", T.ArrayType(T.DoubleType())),
                          T.StructField("__foreign", T.BooleanType())])
    scored = stored(map_arrow(frame, score, kinds), "language-scores")
    names = ["rid", "doc_id", *[col(c) for c in carry]]
    if n_lang == 0:
        kept = F.col("__letters") & claim.isNotNull()
        return scored.select(*names, F.when(kept, claim).otherwise(UNKNOWN).alias("language"), F.lit(1.0).alias("probability"),
                             kept.alias("kept"))

    # counts over all documents, by the language that the text alone suggests
    langs = F.array(*[F.lit(v) for v in languages])
    known = F.slice("__text", 1, n_lang)
    guess = F.when(F.col("__letters") & ~F.col("__foreign"), F.array_position(known, F.array_max(known)).cast("int"))
    judged = scored.withColumn("g", guess).withColumns({
        "__suffix": F.substring_index("__address", ".", -1), "__domain": F.substring_index("__address", ".", -2)})
    seen = judged.where("g is not null")
    total = {r["g"]: r["n"] for r in seen.groupBy("g").agg(F.count(F.lit(1)).alias("n")).collect()}
    everyone = sum(total.values())
    share = [(total.get(k + 1, 0) + 1.0) / (everyone + n_lang) for k in range(n_lang)]
    base = F.array(*[F.lit(float(v)) for v in share])

    def counts(key: str) -> DataFrame:
        """``key, c``: documents of each guessed language."""
        each = seen.where(F.col(key).isNotNull()).groupBy(key, "g").agg(F.count(F.lit(1)).cast("double").alias("n"))
        found = each.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("g", "n"))).alias("m"))  # one entry a language
        return found.select(key, F.transform(F.sequence(F.lit(1), F.lit(n_lang)), lambda k: F.coalesce(F.col("m")[k], F.lit(0.0))).alias("c"))

    def smoothed(c: str, towards: Column) -> Column:
        size = F.aggregate(F.col(c), F.lit(0.0), lambda s, x: s + x)
        return F.transform(F.zip_with(F.col(c), towards, lambda x, p: x + smoothing * p), lambda v: v / (size + smoothing))

    def channel(key: str, name: str) -> DataFrame:
        """``key, name``: log probability of this value given each language,
        smoothed towards its overall share, and for no or any language that share."""
        c = counts(key).withColumn("all", F.aggregate("c", F.lit(0.0), lambda s, x: s + x) / F.lit(float(max(1, everyone))))
        sizes = F.array(*[F.lit(float(total.get(k + 1, 0))) for k in range(n_lang)])
        per = F.zip_with("c", sizes, lambda x, t: F.log((x + smoothing * F.col("all")) / (t + smoothing)))
        return c.select(key, F.concat(per, F.array(F.log("all"), F.log("all"))).alias(name))

    suffix = counts("__suffix").select("__suffix", smoothed("c", base).alias("ps"))
    domain = (counts("__domain").withColumn("__suffix", F.substring_index("__domain", ".", -1)).join(suffix, "__suffix")
              .select("__domain", smoothed("c", F.col("ps")).alias("pd")))
    hosts = (counts("__host").withColumn("__domain", F.substring_index("__host", ".", -2)).join(domain, "__domain", "left")
             .select("__host", smoothed("c", F.coalesce("pd", base)).alias("prior")))
    fused = (judged.join(channel("__declared", "ld"), "__declared", "left").join(channel("__suffix", "ls"), "__suffix", "left")
             .join(hosts, "__host", "left"))
    zero = F.array_repeat(F.lit(0.0), n_lang + 2)
    # a declared language without labels counts as known: it takes the place of no language
    named = claim.isNotNull() & ~F.array_contains(langs, F.coalesce(claim, F.lit("")))
    never = F.lit(float("-inf"))
    last = F.array(F.when(named, never).otherwise(F.lit(float(np.log(UNKNOWN_PRIOR)))), F.when(named, F.lit(0.0)).otherwise(never))
    prior = F.concat(F.transform(F.coalesce("prior", base), lambda p: F.log(p)), last)
    text = F.transform("__text", lambda v: v * TEMPER)
    logs = F.zip_with(F.zip_with(text, prior, lambda x, y: x + y),
                      F.zip_with(F.coalesce("ld", zero), F.coalesce("ls", zero), lambda x, y: x + y), lambda x, y: x + y)
    best = fused.withColumn("__logs", logs).withColumn("__top", F.array_max("__logs"))
    norm = F.aggregate("__logs", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("__top")))
    best = best.withColumns({"__at": F.array_position("__logs", F.col("__top")).cast("int"), "__p": F.lit(1.0) / norm})
    told = F.when(F.col("__foreign"), claim).when(F.col("__at") == n_lang + 2, claim).when(
        F.col("__at") <= n_lang, F.element_at(langs, F.least("__at", F.lit(n_lang))))
    kept = F.col("__letters") & (F.col("__foreign") | (F.col("__at") != n_lang + 1))
    return best.select(*names, F.when(kept, F.coalesce(told, F.lit(UNKNOWN))).otherwise(UNKNOWN).alias("language"),
                       F.when(F.col("__letters") & ~F.col("__foreign"), F.col("__p")).otherwise(1.0).alias("probability"), kept.alias("kept"))
