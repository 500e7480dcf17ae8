"""tessera: small data operators (parse, filter, join, count, fold) as Spark
DataFrame and Column functions.

    from tessera import text, relational, windows, folds, strings
    lines = text.lines_of(docs, "text", ["doc_id"])

Modules: ``strings``, ``numbers``, ``dates``, ``collections`` (Column
expressions); ``text``, ``json``, ``html``, ``literals``, ``parse``
(sources); ``relational``, ``aggregates``, ``windows``, ``folds``,
``sampling`` (DataFrame operators); ``streams`` (Structured Streaming).
"""

from tessera.functions import collections, dates, numbers, strings
from tessera.operators import aggregates, folds, relational, sampling, windows
from tessera.sources import html, json, literals, parse, text
from tessera import streaming as streams

__version__ = "0.1.0"

__all__ = ["aggregates", "collections", "dates", "folds", "html", "json", "literals", "numbers", "parse",
           "relational", "sampling", "streams", "strings", "text", "windows"]
