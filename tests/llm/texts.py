"""Texts for the tests."""

import random

COMMON = ["the", "of", "and", "to", "in", "is", "that", "for"]


def prose(n: int, seed: int) -> str:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randint(3, 9))) for _ in range(n)]
    return " ".join(w if rng.random() < 0.65 else rng.choice(COMMON) for w in words)


def edited(text: str, edits: int, seed: int) -> str:
    rng = random.Random(seed)
    words = text.split(" ")
    for i in rng.sample(range(len(words)), edits):
        words[i] = f"w{rng.randrange(10**9)}"
    return " ".join(words)
