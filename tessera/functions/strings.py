"""String expressions with Python's string semantics, built from Spark columns.

Every function takes and returns ``Column`` so it composes inside any
projection and stays inside whole-stage code generation.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._column import as_column as _col

# The characters Python's str.strip() / str.split() treat as
# whitespace, and the line boundaries of str.splitlines().
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def _char_class(chars: str) -> str:
    """A regex character class of ``chars`` as ranges of code points."""
    points = sorted({ord(c) for c in chars})
    parts, start, prev = [], points[0], points[0]
    for p in points[1:] + [None]:
        if p is not None and p == prev + 1:
            prev = p
            continue
        parts.append(f"\\x{{{start:x}}}" if start == prev else f"\\x{{{start:x}}}-\\x{{{prev:x}}}")
        if p is not None:
            start = prev = p
    return "[" + "".join(parts) + "]"


WHITESPACE_CLASS = _char_class(PY_WHITESPACE)
LINE_BREAK_REGEX = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c\\x1d\\x1e\\x{85}\\x{2028}\\x{2029}]"


def py_strip(c) -> Column:
    """``str.strip()``: Spark's ``trim`` removes spaces only."""
    return F.btrim(_col(c), F.lit(PY_WHITESPACE))


def split_literal(c, delimiter: str, limit: int = -1) -> Column:
    """``str.split(delimiter)``: the delimiter is literal text, not a regex."""
    return F.split(_col(c), re.escape(delimiter), limit)


# Java's \s in Unicode mode (?U) is the White_Space property; with
# \x1c-\x1f added it is exactly Python's whitespace (str.split / str.isspace),
# and it runs as fast as the ASCII \s class.
PY_WHITESPACE_REGEX = "(?U)[\\s\\x1c-\\x1f]+"


def split_whitespace(c) -> Column:
    """``str.split()`` with no argument: runs of whitespace, no empty words."""
    # leading/trailing whitespace leaves empty strings at the ends; drop them
    return F.array_remove(F.split(_col(c), PY_WHITESPACE_REGEX), "")


# line breaks of str.splitlines() other than '\n'
_OTHER_LINE_BREAKS = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"


def split_lines(c) -> Column:
    """``str.splitlines()``: no empty last element, empty text gives [].

    Text holding no line break but '\n' (checked with plain substring
    searches) is split on '\n' directly, a single-character split that
    avoids the regex engine; other text takes the full line-break regex.
    """
    text = _col(c)
    n = F.length(text)
    only_newlines = F.lit(True)
    for ch in _OTHER_LINE_BREAKS:
        only_newlines = only_newlines & ~F.contains(text, F.lit(ch))
    fast = F.split(F.when(F.endswith(text, F.lit("\n")), F.substring(text, 1, n - 1)).otherwise(text), "\n")
    # one final line break is dropped first (a plain test of the last
    # characters, not a regex scan of the whole text)
    body = (F.when(F.substring(text, -2, 2) == "\r\n", F.substring(text, 1, n - 2))
            .when(F.substring(text, -1, 1).rlike("^(" + LINE_BREAK_REGEX + ")$"), F.substring(text, 1, n - 1))
            .otherwise(text))
    full = F.split(body, LINE_BREAK_REGEX)
    return (F.when(text == "", F.array().cast("array<string>"))
            .when(only_newlines, fast)
            .otherwise(full))


# Characters whose title case is not their upper case ('ß' -> 'Ss', the
# 'ǆ' digraphs, ligatures), derived from Python's own case tables.
_TITLE_EXCEPTIONS = {ch: ch.title() for ch in map(chr, range(0x30000)) if ch.title() != ch.upper()}


# A capital sigma that is not followed by a cased letter (case-ignorable
# characters skipped) lower-cases to the final form.
_CASE_IGNORABLE = "\\p{Mn}\\p{Me}\\p{Cf}\\p{Lm}\\p{Sk}'.:·’"
_CASED = "\\p{IsLowercase}\\p{IsUppercase}\\p{IsTitlecase}"
_FINAL_SIGMA = f"Σ(?![{_CASE_IGNORABLE}]*[{_CASED}])"
_CASED_CHAR = f"^[{_CASED}]$"


def title_case(c) -> Column:
    """``str.title()``: title case after any uncased character, lower elsewhere.

    Spark's ``initcap`` only restarts after a blank (``o'neil`` -> ``O'neil``
    where Python gives ``O'Neil``).  A character is *cased* as in Python:
    it has a case mapping or a Lowercase / Uppercase / Titlecase property
    (characters newer than the JVM's Unicode version may differ).  Each
    character is paired with its predecessor
    by ``zip_with`` over a shifted copy of the array (a lambda that indexed
    the outer array would rebuild it for every character).
    """
    # lower case of a capital sigma depends on what follows (Unicode Final_Sigma,
    # as Python applies it): decided once on the whole text before splitting
    chars = F.split(F.regexp_replace(_col(c), _FINAL_SIGMA, "ς"), "")
    exceptions = F.create_map(*[F.lit(x) for kv in _TITLE_EXCEPTIONS.items() for x in kv])
    prevs = F.concat(F.array(F.lit("")), F.slice(chars, 1, F.greatest(F.size(chars) - 1, F.lit(0))))

    def one(ch, prev):
        # cased: has a case mapping, or carries the Lowercase / Uppercase /
        # Titlecase property (e.g. 'ª', 'ĸ'); the regex runs only for
        # characters without a mapping
        prev_cased = (F.upper(prev) != F.lower(prev)) | prev.rlike(_CASED_CHAR)
        title = F.coalesce(F.try_element_at(exceptions, ch), F.upper(ch))
        return F.when(prev_cased, F.lower(ch)).otherwise(title)

    return F.when(_col(c) == "", F.lit("")).otherwise(F.array_join(F.zip_with(chars, prevs, one), ""))


def normalise_key(c) -> Column:
    """Lookup key as typed by a user: stripped, title case."""
    return title_case(py_strip(c))


def is_palindrome(c) -> Column:
    """Ignoring case and blanks, the text equals its reverse."""
    t = F.replace(F.upper(_col(c)), F.lit(" "), F.lit(""))
    return t == F.reverse(t)


def slice_both_ends(c, head: int, tail: int) -> Column:
    """Drop ``head`` characters from the start and ``tail`` from the end.

    Like Python ``s[head:len(s)-tail]``; text shorter than the cut gives ''.
    """
    s = _col(c)
    return F.substring(s, head + 1, F.greatest(F.lit(0), F.length(s) - head - tail))


def substring_before(c, delimiter: str) -> Column:
    """Text before the first ``delimiter`` (whole text when absent)."""
    return F.substring_index(_col(c), delimiter, 1)


def first_char_lower(c) -> Column:
    return F.lower(F.left(_col(c), F.lit(1)))


def contains_text(c, needle, ignore_case: bool = True) -> Column:
    """``needle`` is a constant or, as a Column, a text held by the row."""
    wanted = needle if isinstance(needle, Column) else F.lit(needle)
    if ignore_case:
        return F.contains(F.upper(_col(c)), F.upper(wanted))
    return F.contains(_col(c), wanted)


def repeat_text(c, n) -> Column:
    """``s * n``: zero or fewer repeats give ''."""
    return F.repeat(_col(c), F.greatest(F.lit(0), _col(n)))


def mask_chars(c, shown, placeholder: str = "_", sep: str = " ") -> Column:
    """Show only characters in ``shown`` (case-insensitive), ``_`` elsewhere;
    ``shown`` is a list or, as a Column, a text held by the row."""
    allowed = F.split(F.upper(shown), "") if isinstance(shown, Column) else F.array(*[F.lit(s.upper()) for s in shown])
    chars = F.split(F.upper(_col(c)), "")
    masked = F.transform(
        chars, lambda ch: F.when(F.array_contains(allowed, ch), ch).otherwise(F.lit(placeholder))
    )
    return F.when(_col(c) == "", F.lit("")).otherwise(F.array_join(masked, sep))


def distinct_char_count(c) -> Column:
    """``len(set(word))``."""
    s = _col(c)
    return F.when(s == "", F.lit(0)).otherwise(F.size(F.array_distinct(F.split(s, ""))))


def html_unescape_basic(c) -> Column:
    """Decode the five XML entities (``&amp;`` last, so it is done once)."""
    s = _col(c)
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        s = F.replace(s, F.lit(ent), F.lit(ch))
    return s
