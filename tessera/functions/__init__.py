"""Column expressions: strings, numbers, dates, arrays and maps."""

from tessera.functions import collections, dates, numbers, strings

__all__ = ["collections", "dates", "numbers", "strings"]
