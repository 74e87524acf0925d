"""Invented prose for the tests."""

import random

WORDS = [a + b for a in ("ka", "lo", "mi", "nu", "re", "so", "tu", "va") for b in ("ban", "den", "fir", "gol", "hup", "jas", "kel", "mon")]


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))
