"""Rows shared by the tests of the subpackage."""

import random

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, vocabulary=4000):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))
