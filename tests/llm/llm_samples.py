"""Texts the tests share."""

import random

EDGE = ["", " \n\t", "one", "one two", "<|endoftext|>", "a<|endoftext|>b", "é😀 x y", "\r\n\r\n", "'s''re", "x" * 3000, "z " * 5000]


def words(seed: int, count: int, vocabulary: int = 400) -> list[str]:
    draw = random.Random(seed)
    return [f"{draw.choice('bcdfgkl')}{draw.choice('aeiou')}{draw.randrange(vocabulary)}q" for _ in range(count)]
