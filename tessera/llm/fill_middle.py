"""Fill-in-middle transformation by counted quantifiers.

``regexp_count`` gives the number of units of a text (code points, unless
another unit is named).  Two of a row's own random numbers choose cuts ``a <= b``,
and a pattern of that row, ``\\A(unit{a}+)(unit{b-a}+)(.*+)\\z``, captures prefix,
middle and suffix in one match, whose replacement is already the output.  The
counted groups are possessive: the matcher counts in a loop, never backtracks,
and needs no stack however long the text is.  Spark functions only, one pass,
no shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm._common import col, hidden, without

MARKERS = ("<P>", "<S>", "<M>")
#: Units that one counted match takes together, so that counting keeps no list of single units.
BLOCK = 1024


def unit_count(text: Column, unit: str = ".") -> Column:
    """How many units stand one after another from the start of ``text``."""
    blocks = F.regexp_count(text, F.lit(rf"(?s)\G(?:{unit}){{{BLOCK}}}+"))
    rest = F.regexp_replace(text, rf"(?s)\A(?:(?:{unit}){{{BLOCK}}}+)*+", "")
    return blocks.cast("bigint") * BLOCK + F.regexp_count(rest, F.lit(rf"(?s)\G(?:{unit})"))


def _as_replacement(marker: str) -> str:
    return marker.replace("\\", "\\\\").replace("$", "\\$")


def _check(markers: tuple[str, str, str]) -> None:
    heads = {m[:1] for m in markers}
    if len(set(markers)) < 3 or "" in heads or any(h in m[1:] for h in heads for m in markers):
        raise ValueError("markers must differ and hold the first character of none of them further on")


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = ".", seed: str = "1",
                   moved_percent: int = 90, spm_percent: int = 20, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``docs`` with ``n, form, prefix_chars, middle_chars, output``.

    ``n`` counts the units of the text; ``prefix_chars`` and ``middle_chars`` are
    numbers of units too.  Forms: ``psm`` (prefix, suffix, middle, each after its
    marker), ``spm`` (suffix first) and ``plain`` (the text as it is, lengths null).  The random
    numbers are the first four 32-bit groups of the SHA-256 of ``seed:id``: two
    for the cuts, one for plain or moved, one for the form; so a row's result does
    not depend on the others or on the partitions.

    Defined cases: null texts count as empty, empty texts are plain, as are texts
    that hold a marker; a null id is hashed as the empty string; rows that repeat
    an id are cut alike if their texts are equal; a text of any length is one row's work, in
    time and memory in proportion to it; an empty table gives an empty result; input columns
    named like the new ones give way.  A ``unit`` other than ``.`` is a Java
    pattern without capturing groups that never matches the empty string; what follows the last unit
    belongs to the suffix.
    """
    _check(markers)
    keep = without(docs, ["n", "form", "prefix_chars", "middle_chars", "output"])
    body, digest, low, high = (hidden(docs, x) for x in ("body", "digest", "low", "high"))
    n = hidden(docs, "n")
    seeded = F.concat(F.lit(f"{seed}:"), F.coalesce(col(id_col).cast("string"), F.lit("")))
    out = docs.select(*[col(c) for c in keep], F.coalesce(col(text_col), F.lit("")).alias(body),
                      F.sha2(seeded.cast("binary"), 256).alias(digest))
    out = out.withColumn(n, unit_count(col(body), unit))

    def number(k: int) -> Column:
        return F.conv(F.substring(col(digest), 8 * k + 1, 8), 16, 10).cast("bigint")

    first, second = number(0) % (col(n) + 1), number(1) % (col(n) + 1)
    held = F.lit(False)
    for m in markers:
        held = held | F.contains(col(body), F.lit(m))
    plain = (col(body) == "") | held | (number(2) % 100 >= moved_percent)
    form = F.when(plain, "plain").when(number(3) % 100 < spm_percent, "spm").otherwise("psm")
    out = out.withColumns({low: F.least(first, second), high: F.greatest(first, second), "form": form})

    pattern = F.concat(F.lit(rf"(?s)\A((?:{unit}){{"), col(low), F.lit(rf"}}+)((?:{unit}){{"), col(high) - col(low),
                       F.lit(r"}+)(.*+)\z"))
    p, s, m = map(_as_replacement, markers)
    order = F.when(F.col("form") == "spm", f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    moved = F.regexp_replace(col(body), pattern, order)
    shown = F.col("form") != "plain"
    return out.select(*[col(c) for c in keep], col(n).alias("n"), "form", F.when(shown, col(low)).alias("prefix_chars"),
                      F.when(shown, col(high) - col(low)).alias("middle_chars"),
                      F.when(shown, moved).otherwise(col(body)).alias("output"))


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``fill_in_middle`` turned into ``output``.  A moved text holds
    no marker, and none can arise where a part meets one (see ``_check``), so
    the first of each kind is the one put in."""
    _check(markers)
    p, s, m = map(re.escape, markers)
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)\z", "$2$3$1")
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
