import numpy as np
from pyspark.sql import functions as F

from tessera.llm import language_id as lang
from tessera.llm.queries import QUERIES

from .conftest import SF01


def _bucket_counts(text):
    data = np.frombuffer((text or "").encode(), np.uint8)
    return lang.trigram_buckets(data) if len(data) >= 3 else np.zeros(0, int)


def test_query_against_brute_force_fusion(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()]
    frame = spark.read.parquet(f"{SF01}/documents.parquet")
    languages, model = lang.fit_text_model(frame, F.col("lang"))
    n = len(languages)
    scores = np.array([model[_bucket_counts(d["text"])].astype(float).sum(0) for d in docs])
    guess = scores[:, :n].argmax(1)
    total = np.bincount(guess, minlength=n)
    share = (total + 1) / (len(docs) + n)
    got = {r["doc_id"]: r for r in QUERIES["op5_language_id"](spark, SF01).collect()}
    assert len(got) == len(docs)

    def counts(key, value):
        return np.array([sum(g == k and d[key] == value for g, d in zip(guess, docs, strict=True)) for k in range(n)], float)

    seen = {}
    for d, s in zip(docs, scores, strict=True):
        for key in ("lang", "source"):
            if (key, d[key]) not in seen:
                seen[key, d[key]] = counts(key, d[key])
        c, h = seen["lang", d["lang"]], seen["source", d["source"]]
        all_ = c.sum() / len(docs)
        logs = s * lang.TEMPER
        logs[:n] += np.log((c + 20 * all_) / (total + 20)) + np.log((h + 20 * share) / (h.sum() + 20))
        logs[n] += np.log(all_) + np.log(lang.UNKNOWN_PRIOR)
        p = np.exp(logs - logs.max())
        p /= p.sum()
        r = got[d["doc_id"]]
        assert r["language"] == [*languages, "und"][p.argmax()] and abs(r["probability"] - p.max()) < 1e-6


def test_held_out_accuracy_of_the_text_alone(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    known = docs.where("doc_id % 2 = 0")
    model = lang.fit_text_model(known, F.col("lang"))
    rest = docs.where("doc_id % 2 = 1")
    got = lang.language_id(rest, carry=("lang",), model=model)
    assert got.where("language = lang").count() >= 0.98 * rest.count()
    assert got.where("not kept").count() <= 0.01 * rest.count()


def test_wrong_declarations_are_outvoted(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("length(text) > 300")
    wrong = F.when(F.col("doc_id") % 7 == 0, F.when(F.col("lang") == "en", "fr").otherwise("en")).otherwise(F.col("lang"))
    out = lang.language_id(docs.withColumn("said", wrong), declared=F.col("said"), label=F.col("said"), carry=("lang",))
    assert out.where("language = lang").count() >= 0.99 * docs.count()


def test_edges(edges, nothing, spark):
    out = lang.language_id(edges, declared=F.col("lang"), host=F.col("source"), carry=("n.lines",)).collect()
    assert len(out) == edges.count()
    for r in out:
        if r["doc_id"] in (0, 1, 2):
            assert (r["language"], r["probability"], r["kept"]) == ("und", 1.0, False)
    assert lang.language_id(nothing, declared=F.col("lang")).collect() == []
    plain = lang.language_id(edges).collect()  # no labels at all
    assert {(r["language"], r["kept"]) for r in plain} == {("und", False)}


def test_random_bytes_are_no_language(spark):
    rng = np.random.default_rng(0)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text", "lang")
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz0123456789+/="))
    junk = [(10**6 + i, "".join(rng.choice(letters, 500)), None) for i in range(20)]
    out = lang.language_id(docs.unionByName(spark.createDataFrame(junk, docs.schema)), declared=F.col("lang"))
    assert out.where("doc_id >= 1000000 and kept").count() == 0
    assert out.where("doc_id < 1000000 and not kept").count() <= 5


def test_pages_use_markup_suffix_and_host(spark):
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    out = lang.language_id(pages, id_col="page_id", text_col="html", declared=lang.markup_language(F.col("html")), url=F.col("url"))
    assert out.count() == pages.count() and out.where("kept").count() == pages.count()
    rows = spark.createDataFrame([("<HTML class=x LANG='pt-BR'>", "http://u:p@A.Example.DE:80/x"), ("<p lang=fr>", "nothing"), (None, None)], "h string, u string")
    got = rows.select(lang.markup_language(F.col("h")), lang.address_host(F.col("u"))).collect()
    assert [tuple(r) for r in got] == [("pt", "a.example.de"), (None, None), (None, None)]


def test_host_prior_decides_without_text(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("length(text) > 200 and lang in ('en', 'fr')")
    urls = docs.select("doc_id", "text", "lang", F.concat(F.lit("http://a."), "lang", F.lit(".example/x")).alias("url"))
    short = spark.createDataFrame([(-1, "aa", None, "http://a.fr.example/y"), (-2, "aa", None, "http://b.fr.example/y"),
                                   (-3, "aa", None, "http://a.en.example/y")], urls.schema)
    out = lang.language_id(urls.unionByName(short), url=F.col("url"), label=F.col("lang"))
    got = {r["doc_id"]: r["language"] for r in out.where("doc_id < 0").collect()}
    assert got == {-1: "fr", -2: "fr", -3: "en"}  # b.fr.example by its domain


def _invented(rng, k):
    """Words of an invented language."""
    own = rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 9, replace=False)
    return ["".join(rng.choice(own, 5)) for _ in range(30)]


def test_every_label_is_a_language(spark):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(80):  # one to four rows each
        words = _invented(rng, k)
        rows += [(100 * k + i, " ".join(rng.choice(words, 60)), f"q{k:02}") for i in range(1 + k % 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    languages, _ = lang.fit_text_model(docs, F.col("lang"))
    assert sorted(languages) == [f"q{k:02}" for k in range(80)]
    out = lang.language_id(docs, declared=F.col("lang"), carry=("lang",))
    assert out.where("kept and language = lang").count() == len(rows)


def test_unknown_scripts_and_declarations_are_kept(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").where("lang in ('en', 'fr')").select("doc_id", "text", F.col("lang").alias("label"), F.lit(None).cast("string").alias("said"))
    georgian = "ყველა ადამიანი იბადება " * 20
    swahili = "watu wote wamezaliwa huru hadhi na haki zao ni sawa wote wamejaliwa akili na dhamiri hivyo yapasa watendeane kindugu " * 3
    english = docs.where("label = 'en' and length(text) > 300").first()["text"]
    more = spark.createDataFrame([(-1, georgian, None, None), (-2, georgian, None, "ka"), (-3, georgian + " 12 ok", None, "und"),
                                  (-4, swahili, None, "sw"), (-5, english, None, "sw"), (-6, "12 34", None, "sw")], docs.schema)
    out = lang.language_id(docs.unionByName(more), declared=F.col("said"), label=F.col("label"))
    got = {r["doc_id"]: (r["language"], r["kept"]) for r in out.where("doc_id < 0").collect()}
    assert got == {-1: ("und", True), -2: ("ka", True), -3: ("und", True), -4: ("sw", True), -5: ("en", True), -6: ("und", False)}
    alone = lang.language_id(more, declared=F.col("said"), label=F.col("label"))  # no labels at all
    assert {r["doc_id"]: (r["language"], r["kept"]) for r in alone.collect()} == {
        -1: ("und", False), -2: ("ka", True), -3: ("und", False), -4: ("sw", True), -5: ("sw", True), -6: ("und", False)}


def test_scripts_of_letters():
    text = "a1 éЖ中𐐀ყ’"
    data = np.frombuffer(text.encode(), np.uint8)
    script, _ = lang._scripts()
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    assert lang.letter_scripts(data)[starts].tolist() == [int(script[ord(c)]) for c in text]
    assert script[ord("a")] == script[ord("é")] > 0 and script[ord("1")] == 0 and lang.letter_scripts(data).astype(bool).sum() == 6


def test_bounded_hashes_hold_the_smallest(spark):
    """Of 20,000 texts of a label (two thirds of them copies of one) and 30 of
    another, the rows fitted on are those of the smallest hashes, all the same."""
    assert lang.hash_bound(400, 30) == (1 << 63) - 1
    rows = spark.range(60_000).selectExpr("if(id < 30, 'b', 'a') as label", "if(id % 3 = 0, concat('t', id), 'copy') as text")
    hashes = sorted(r[0] for r in rows.where("label = 'a'").selectExpr("xxhash64(text) as h").distinct().collect())
    below = [h for h in hashes if h <= lang.hash_bound(400, len(hashes))]
    assert 400 < len(below) < 2000 and below[:400] == hashes[:400]
