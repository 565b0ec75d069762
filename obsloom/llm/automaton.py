"""A minimal acyclic transducer: words to numbers over states that share prefixes and suffixes.

Built from sorted words, state by state: once a word branches off, the states behind the branch are
replaced by equal ones that exist already. A transition carries how many words sort before those
behind it, so the sum along a path is the word's rank; ``outputs`` has the ids for each rank. All is
kept in flat arrays in one file that workers map into memory; a lookup walks all words at once.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np

DEAD = -1


def build(words: list[bytes], outputs: Iterable[list[int]]) -> dict[str, np.ndarray]:
    """Arrays of the automaton for ``words``, sorted and distinct, with the ids of each."""
    register: dict[tuple, int] = {}
    edges: list[tuple[tuple[int, int], ...]] = []  # of each finished state: (label, target)
    final: list[bool] = []
    counts: list[int] = []  # words behind each state
    open_edges: list[list[list[int]]] = [[]]  # along the current word: [label, target]; the last target is open
    open_final = [False]

    def finish(edge_list, is_final) -> int:
        key = (tuple(map(tuple, edge_list)), is_final)
        if (state := register.get(key)) is None:
            state = register[key] = len(edges)
            edges.append(key[0])
            final.append(is_final)
            counts.append(is_final + sum(counts[t] for _, t in key[0]))
        return state

    def close(depth: int) -> None:
        while len(open_edges) > depth + 1:
            state = finish(open_edges.pop(), open_final.pop())
            open_edges[-1][-1][1] = state

    before = b""
    for word in words:
        shared = 0
        while shared < min(len(before), len(word)) and before[shared] == word[shared]:
            shared += 1
        close(shared)
        for label in word[shared:]:
            open_edges[-1].append([label, DEAD])
            open_edges.append([])
            open_final.append(False)
        open_final[-1] = True
        before = word
    close(0)
    root = finish(open_edges[0], open_final[0])
    keys, targets, adds = [], [], []
    for state, own in enumerate(edges):
        behind = int(final[state])
        for label, target in own:
            keys.append(state * 256 + label)
            targets.append(target)
            adds.append(behind)
            behind += counts[target]
    ids = [list(x) for x in outputs]
    return {
        "keys": np.array(keys, np.int64),
        "targets": np.array(targets, np.int32),
        "adds": np.array(adds, np.int32),
        "final": np.array(final, bool),
        "root": np.array([root], np.int64),
        "offsets": np.concatenate([[0], np.cumsum([len(x) for x in ids], dtype=np.int64)]).astype(np.int64),
        "outputs": np.array([i for x in ids for i in x], np.int32),
    }


def save(arrays: dict[str, np.ndarray], path: str) -> None:
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = [a.dtype.str, len(a), at]
        at += -(-a.nbytes // 64) * 64
    text = json.dumps(head).encode()
    with open(path, "wb") as f:
        f.write(len(text).to_bytes(8, "little") + text)
        start = f.tell()
        for name, a in arrays.items():
            f.seek(start + head[name][2])
            f.write(a.tobytes())
        f.truncate(start + at)


def load(path: str) -> dict[str, np.ndarray]:
    """The arrays, mapped into memory."""
    with open(path, "rb") as f:
        size = int.from_bytes(f.read(8), "little")
        head = json.loads(f.read(size))
    return {
        name: np.memmap(path, dtype, "r", 8 + size + at, (n,)) if n else np.empty(0, dtype) for name, (dtype, n, at) in head.items()
    }


def ranks(a: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The rank of each word ``data[start : start + length]``, or -1 if the automaton lacks it."""
    out = np.full(len(starts), DEAD, np.int64)
    if not len(a["keys"]):
        return out
    live = np.arange(len(starts))
    state, total = np.full(len(starts), a["root"][0], np.int64), np.zeros(len(starts), np.int64)
    for i in range(int(lengths.max(initial=0)) + 1):
        ended = lengths[live] == i
        if ended.any():
            done = live[ended]
            out[done] = np.where(a["final"][state[ended]], total[ended], DEAD)
            live, state, total = live[~ended], state[~ended], total[~ended]
        if not len(live):
            break
        key = state * 256 + data[starts[live] + i]
        at = np.minimum(np.searchsorted(a["keys"], key), len(a["keys"]) - 1)
        found = a["keys"][at] == key
        live, at = live[found], at[found]
        state, total = a["targets"][at].astype(np.int64), total[found] + a["adds"][at]
    return out
