"""The card tables used by the scoring and dealing operators.

Fixed values (they must equal the reference's for equal results): suit
order, rank order and the value of each rank.  An Ace counts 11, or 1 when
the hand would otherwise be over 21.
"""

from __future__ import annotations

# Fixed values.
SUITS = ("Hearts", "Diamonds", "Spades", "Clubs")
RANKS = ("Two", "Three", "Four", "Five", "Six", "Seven", "Eight", "Nine", "Ten", "Jack", "Queen", "King", "Ace")
VALUES = {"Two": 2, "Three": 3, "Four": 4, "Five": 5, "Six": 6, "Seven": 7, "Eight": 8, "Nine": 9, "Ten": 10,
          "Jack": 10, "Queen": 10, "King": 10, "Ace": 11}
FLEXIBLE_RANK = "Ace"
BLACKJACK = 21
