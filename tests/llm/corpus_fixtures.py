from __future__ import annotations

import pytest

WORDS = [f"w{i}" for i in range(400)]


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words by a seed, so that equal calls give equal texts."""
    import random

    def make(seed: int, n: int) -> str:
        draw = random.Random(seed)
        return " ".join(draw.choice(WORDS) for _ in range(n))

    return make


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Nulls in every column, empty and very long texts, repeated rows and columns with clashing names."""
    long = prose(9, 30_000)
    return [
        (1, None, None, None, None, "x"), (None, "a b c", "src", "en", 5, None), (2, "", "src", "en", 0, "y"), (3, long, "src", None, 9, "z"),
        (4, long, None, "en", 9, "z"), (5, "tie tie tie", "src", "en", 11, "z"), (5, "tie tie tie", "src", "en", 11, "z"), (6, " \n\t ", "src", "en", 3, ""),
        (7, "a" * 5000, "src", "en", 5000, ""), (8, "one two three four five six", "src", "en", 1, ""), (None, None, None, None, None, None),
    ]

