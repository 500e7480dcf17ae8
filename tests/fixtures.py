"""Test inputs described in FIXTURES.md, generated from their descriptions."""

from __future__ import annotations


def primes_below(n: int) -> list[int]:
    sieve = [True] * n
    sieve[0:2] = [False, False]
    for i in range(2, int(n ** 0.5) + 1):
        if sieve[i]:
            sieve[i * i::i] = [False] * len(sieve[i * i::i])
    return [i for i, p in enumerate(sieve) if p]


def is_happy(n: int) -> bool:
    seen = set()
    while n != 1 and n not in seen:
        seen.add(n)
        n = sum(int(d) ** 2 for d in str(n))
    return n == 1


def happy_lines() -> list[str]:
    return [str(i) for i in range(1, 1001) if is_happy(i)]


def prime_lines() -> list[str]:
    """Primes below 1000, one per line; every tenth line from 10 to 160
    carries a trailing blank."""
    out = []
    for i, p in enumerate(primes_below(1000), start=1):
        out.append(f"{p} " if i % 10 == 0 and 10 <= i <= 160 else str(p))
    return out


def names_lines() -> list[str]:
    """Lea 54, Darth 30, Luke 15, Darthk 1; first seen Darthk, Luke, Darth, Lea."""
    first = ["Darthk", "Luke", "Darth", "Lea"]
    rest = []
    for i in range(53):
        rest.append("Lea")
        if i < 29:
            rest.append("Darth")
        if i < 14:
            rest.append("Luke")
    return first + rest


LIST_A = [1, 1, 2, 3, 5, 5, 8, 13, 21, 34, 55, 89]
LIST_B = [1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10, 11, 12, 13]
DUPS = [1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 11, 12, 13]
LIST_A2 = [1, 1, 2, 3, 5, 8, 13, 21, 34, 55, 89]
LIST_B2 = [1, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13]
SQUARES = [1, 4, 9, 16, 25, 36, 49, 64, 81, 100]
ORDERED_MIXED = [1, 2, 3, 4, 5.5, 6, 8, 9, 11]
PROBES = [0, 1, 2, 3, 4, 5.5, 6, 7, 8, 9, 10]

BIRTHDAYS = [("Ewa", "1988-04-13"), ("Ewelina", "1982-07-02"), ("Karol", "1983-07-13"), ("Artur", "1980-03-14")]
BIRTHDAY_JSON = '{"Ewa": "1988-04-13", "Ewelina": "1982-07-02", "Artur": "1980-07-02"}'

BOARDS = [
    [[1, 1, 0, 0], [2, 1, 0, 1], [2, 2, 1, 2], [2, 1, 1, 1]],
    [[2, 1, 1, 0], [2, 2, 0, 1], [2, 0, 2, 2], [2, 1, 0, 2]],
    [[0, 0, 0, 0], [1, 2, 1, 2], [2, 1, 2, 1], [1, 1, 2, 2]],
]

MOVES = [("1,2", "ok"), ("1", "too_few"), ("1,2,3", "too_many"), ("a,2", "not_integer"),
         ("0,2", "too_low"), ("4,4", "too_high")]
