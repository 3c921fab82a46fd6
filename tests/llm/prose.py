"""Invented text for the tests of this folder."""

import random

SYLLABLES = "ba ke lo mi nu ra so ti ve wo zu ch".split()


def words(random_, n):
    return ["".join(random_.choice(SYLLABLES) for _ in range(random_.randint(1, 3))) for _ in range(n)]


def prose(seed, n):
    return " ".join(words(random.Random(seed), n))
