"""What ``op10`` does for many groups, chains and texts at once, against the same one by one."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import xxhash

from obsloom.llm import chaining, minhash


def test_most_groups_of_matches_are_chained_together(monkeypatch):
    """Groups of one match or one diagonal need no tree; all groups have the chains that they have alone."""
    random.seed(41)
    made = {}
    for group in range(60):
        n = random.randint(1, 30)
        steps = [sum(random.choices([1, 2, 9, 17, 18, 40], [9, 9, 4, 2, 1, 1])[0] for _ in range(i)) for i in range(n)]
        crossing = [(random.randrange(60), random.randrange(60)) for _ in range(n)]
        made[group // 2, group % 2 - 1] = sorted(set({0: [(n, 3)], 1: [(x, x + 7) for x in steps], 2: [(i, i) for i in range(n)], 3: crossing}[group % 4]))
    rows = sorted((doc, first, p, q) for (doc, first), own in made.items() for p, q in own)
    columns = [np.array(c) for c in zip(*(r for r in rows for _ in range(1 + r[2] % 2)), strict=True)]  # some come twice
    plain, expected = chaining.chains, []
    for (doc, first), own in made.items():
        pos, other = (np.array(c, np.int32) for c in zip(*own, strict=True))
        some = chaining.thinned(pos, other, 5, np.zeros(len(pos), np.int64))
        expected += [(doc, first, pos[some][x].tolist(), other[some][x].tolist()) for x in plain(pos[some], other[some])]
    asked = []
    monkeypatch.setattr(chaining, "chains", lambda pos, *rest: asked.append(len(pos)) or plain(pos, *rest))
    got = chaining.chained_groups(*columns[:2], *(c.astype(np.int32) for c in columns[2:]), 5).to_pylist()
    assert sorted(tuple(r.values()) for r in got) == sorted(expected)
    assert len(asked) < 35


def test_chains_are_aligned_together():
    """A batch's passages are those that its chains have one by one."""
    rng = np.random.default_rng(42)
    rows = []
    for i in range(300):
        a = rng.integers(0, 500, rng.integers(5, 250)).astype(np.uint32)
        b = np.where(rng.random(len(a)) < rng.choice([0, 0.05, 0.2, 0.5]), rng.integers(0, 500, len(a)), a).astype(np.uint32)
        at = sorted(set(rng.integers(0, len(a) - 4, 1 + 2 * (i % 3 == 0)).tolist()))
        if i % 50 == 7:
            at[-1] = len(a) - 3  # the place of another text with this id
        rows.append({"doc": i, "first": -i, "pos": [p + 64 for p in at], "other": [p + 128 for p in at], "from": 64, "other_from": 128, "words": a.tobytes(), "other_words": b.tobytes()})
    kinds = {"doc": pa.int64(), "first": pa.int64(), "pos": pa.list_(pa.int32()), "other": pa.list_(pa.int32()), "from": pa.int32(), "other_from": pa.int32(), "words": pa.binary(), "other_words": pa.binary()}
    batch = pa.RecordBatch.from_pylist(rows, pa.schema(list(kinds.items())))
    for min_words, min_identity in ((50, 80), (12, 60)):
        expected = []
        for r in rows[2:]:
            a, b, at = np.frombuffer(r["words"], np.uint32), np.frombuffer(r["other_words"], np.uint32), [p - 64 for p in r["pos"]]
            found = chaining.aligned(a, b, at, at, 5, min_identity, min_words) if at[-1] + 5 <= len(a) else []
            fits = [x for x in found if x[1] - x[0] >= min_words and 100 * x[4] >= min_identity * max(x[1] - x[0], x[3] - x[2])]
            expected += [(r["doc"], s + 64, e + 64, r["first"], s2 + 128, e2 + 128, same) for s, e, s2, e2, same in fits]
        got = [tuple(r.values()) for r in chaining.passages_of(batch.slice(2), 5, min_words, min_identity).to_pylist()]
        assert sorted(got) == sorted(expected) and len(got) > 50


def test_common_words_equal_the_table():
    rng = np.random.default_rng(43)
    for _ in range(300):
        a, b = (rng.integers(0, 12, rng.integers(0, 90)) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert chaining.common(a, b) == table[-1, -1]


def test_words_are_hashed_alike_in_lists_and_columns():
    texts = ["", " A  b\x0b", "x", "\x0cA\rÄ b c\x1cd e \x85", " " * 5, "é\x00 ü", "b"]
    expected = [xxhash.xxh3_64_intdigest(w) for t in texts for w in t.encode().lower().split()]
    for given in (texts, pa.array(["left out", *texts]).slice(1)):
        hashes, counts = minhash.word_hashes(given)
        assert hashes.tolist() == expected and counts.tolist() == [len(t.encode().split()) for t in texts]
