"""Fuzzy passages by collinear chaining of shared seeds.

1. Of every ``span`` words in a row the k-mer of least hash is a seed. A seed found at up to ``FEW``
   places is matched at every pair of them that lies in two documents. At the places of a more frequent
   seed, the ``LONGER`` words that start there are the seed, and so on by length: each level is matched
   likewise. Frequent seeds of any level are matched with their first place in the smallest document id,
   so matches grow with the places, never with all pairs. A seed of the last length is a passage by
   itself, which that match finds.
2. The matches of a pair of documents are chained: the best score of a chain that ends in a match is
   the seed's length plus the best of the chains that end before it in both documents, less a cost for
   every word skipped in either. With the cost split into a part of each match, the best
   predecessor is a prefix maximum over the places in the other document, kept in a Fenwick tree.
3. Chains are aligned word by word: between seeds, and outwards from the ends for as long as matches
   outweigh differences. Those of at least ``min_words`` words and ``min_identity`` percent equal words
   are passages.

The first document that holds a passage keeps it; in the others it is a span to remove.

Defined results: null and empty texts, and rows without an id, have no passages. Rows that repeat an
id are one document: each of their texts is aligned for itself. Columns of the input named as a
column of the result are replaced.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.llm.common import WORD, groups, mapped, pieces, runs, stored
from obsloom.llm.minhash import mixed, word_hashes
from obsloom.llm.suffix import least

SEED, SPAN = 5, 3
FEW, LONGER = 16, (13, 26)  # and MIN_WORDS at last
MIN_WORDS, MIN_IDENTITY = 50, 80
GAP_COST = 0.2
#: Word ranges are fetched from documents in steps of this, so that many chains share a range.
STEP = 64
HELD = 1 << 20  # places of seeds that a task packs at once
REACH = 64  # words beyond a chain's ends in which its passage is looked for
_RANDOM = np.random.default_rng(8_12)
PLACES = _RANDOM.integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def seeds(hashes: np.ndarray, k: int = SEED, span: int = SPAN) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the seeds of one document's word hashes."""
    n = len(hashes) - k + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        mers = hashes[:n] * PLACES[0]
        for i in range(1, k):
            mers += hashes[i : n + i] * PLACES[i]
    mers = mixed(mers)
    at = least(mers, span) if n >= span else np.array([mers.argmin()])
    at = at[np.concatenate([[True], at[1:] != at[:-1]])]
    return at.astype(np.int64), mers[at].view(np.int64)


def chains(pos: np.ndarray, other: np.ndarray, k: int = SEED, gap_cost: float = GAP_COST) -> list[list[int]]:
    """Disjoint chains of matches ``pos[i]``-``other[i]``, best first; the matches come sorted by ``pos``, then ``other``."""
    places = sorted(set(other.tolist()))
    size = len(places)
    best: list[tuple[float, int]] = [(-1.0, -1)] * (size + 1)  # Fenwick tree of prefix maxima
    score, parent, waiting = [], [], []
    before = -1
    for i, (p, q) in enumerate(zip(pos.tolist(), other.tolist(), strict=True)):
        if p != before:  # matches at one place do not follow each other
            for value, slot, j in waiting:
                while slot <= size:
                    if value > best[slot][0]:
                        best[slot] = (value, j)
                    slot += slot & -slot
            waiting, before = [], p
        slot = bisect_left(places, q)
        top, at = (-1.0, -1), slot
        while at:
            top = max(top, best[at])
            at -= at & -at
        cost = gap_cost * (p + q)
        gain = top[0] - cost if top[1] >= 0 else -1.0
        if top[1] >= 0:
            gain += 2 * gap_cost * min(k, p - pos[top[1]], q - other[top[1]])  # words of the seed are not skipped
        score.append(k + max(0.0, gain))
        parent.append(top[1] if gain > 0 else -1)
        waiting.append((score[-1] + cost, slot + 1, i))
    used, out = [False] * len(score), []
    for i in sorted(range(len(score)), key=score.__getitem__, reverse=True):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = parent[i]
        if chain:
            out.append(chain[::-1])
    return out


def whole_groups(pos: np.ndarray, other: np.ndarray, cuts: np.ndarray, k: int = SEED, gap_cost: float = GAP_COST) -> np.ndarray:
    """Of groups of matches, sorted as for ``chains``, those that are one chain as they are: all matches on one diagonal and
    no step so wide that it costs as much as a seed scores. Each match then follows the one before it with a higher score."""
    step, diagonal = np.diff(pos.astype(np.int64)), np.diff(pos.astype(np.int64) - other)
    apart = np.append(0, np.cumsum((diagonal != 0) | (2 * gap_cost * (step - k) >= k - 1e-6)))
    return apart[cuts[1:] - 1] == apart[cuts[:-1]]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Equal words in the best order-preserving pairing of two short ranges."""
    if len(a) == len(b) and (a == b).all():
        return len(a)
    # A column of the table of best pairings in the bits of one number: a bit is off where the next word of ``a`` adds one.
    at: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        at[x] = at.get(x, 0) | 1 << i
    full = column = (1 << len(a)) - 1
    for y in b.tolist():
        if met := column & at.get(y, 0):
            column = ((column + met) | (column - met)) & full
    return len(a) - column.bit_count()


def extended(a: np.ndarray, b: np.ndarray, drop: int = 16) -> tuple[int, int]:
    """How far two word ranges go on alike, and how many of these words are equal."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    stop = np.flatnonzero(score < np.maximum.accumulate(np.maximum(score, 0)) - drop)
    score = score[: stop[0]] if len(stop) else score
    length = int(score.argmax()) + 1 if len(score) and score.max() > 0 else 0
    return length, int(same[:length].sum())


def reached(left: np.ndarray, right: np.ndarray, words: int, longest: int, equal: int, min_words: int, min_identity: int) -> tuple | None:
    """The best ends, in equal words to the ``left`` and ``right`` of a core, that make it a passage: lengths and equal words, or None."""
    l, r = (np.append(0, np.flatnonzero(x[:min_words]) + 1) for x in (left, right))
    more, same = l[:, None] + r, np.arange(len(l))[:, None] + np.arange(len(r)) + equal
    score = np.where((words + more >= min_words) & (100 * same >= min_identity * (longest + more)), 3 * same - 2 * (longest + more), -(1 << 40))
    i, j = np.unravel_index(score.argmax(), score.shape)
    return (int(l[i]), int(r[j]), int(same[i, j])) if score[i, j] > -(1 << 40) else None


def aligned(
    a: np.ndarray, b: np.ndarray, pos: list[int], other: list[int], k: int = SEED, min_identity: int = MIN_IDENTITY, min_words: int = MIN_WORDS
) -> list[tuple]:
    """``(start, end, start, end, equal words)`` of a chain's alignments; places are relative to the word ranges.

    The chain is cut where the words between its seeds differ too much: a part is the stretch of
    greatest score, where differences weigh such that a stretch at ``min_identity`` percent has none.
    """
    if len(pos) == 1:  # most are found by chance
        (p,), (q,), n = pos, other, max(REACH, min_words)
        back, on = min(p, q, n), min(len(a) - p, len(b) - q, n + k)
        if 100 * int((a[p - back : p + on] == b[q - back : q + on]).sum()) < min_identity * min_words:
            return []
    equal, longest = [], []
    for p, q, p2, q2 in zip(pos, other, pos[1:], other[1:], strict=False):
        equal.append(common(a[p:p2], b[q:q2]))
        longest.append(max(p2 - p, q2 - q))
    weight = min_identity / max(1, 100 - min_identity)
    out, todo = [], [(0, len(pos) - 1)]
    while todo:
        first, last = todo.pop()
        best, low, high, score, since = 0.0, first, first, 0.0, first
        for i in range(first, last):
            score += equal[i] - weight * (longest[i] - equal[i])
            if score <= 0:
                score, since = 0.0, i + 1
            elif score > best:
                best, low, high = score, since, i + 1
        todo += [(x, y) for x, y in ((first, low - 1), (high + 1, last)) if y >= x]
        right, same_right = extended(a[pos[high] + k :], b[other[high] + k :])
        left, same_left = extended(a[: pos[low]][::-1], b[: other[low]][::-1])
        core = sum(equal[low:high]) + k
        same = core + same_left + same_right
        if pos[high] + k - pos[low] + left + right < min_words:
            flanks = []
            for x, y in ((a[: pos[low]][::-1], b[: other[low]][::-1]), (a[pos[high] + k :], b[other[high] + k :])):
                n = min(len(x), len(y))
                flanks.append(x[:n] == y[:n])
            words = pos[high] + k - pos[low]
            if best_ends := reached(*flanks, words, k + sum(longest[low:high]), core, min_words, min_identity):
                left, right, same = best_ends
        out.append((pos[low] - left, pos[high] + k + right, other[low] - left, other[high] + k + right, same))
    return out


def thinned(pos: np.ndarray, other: np.ndarray, k: int, group: np.ndarray) -> np.ndarray:
    """Of the matches of each ``group`` that overlap on a diagonal one per ``k`` words and the last: the words between are equal. Their places, in order."""
    order = np.lexsort((pos, pos.astype(np.int64) - other, group))
    p, diagonal, group = pos[order].astype(np.int64), (pos.astype(np.int64) - other)[order], group[order]
    opens = np.append(True, (group[1:] != group[:-1]) | (diagonal[1:] != diagonal[:-1]) | (p[1:] - p[:-1] > k))
    run = np.cumsum(opens) - 1
    step = (p - p[opens][run]) // k
    keep = opens | np.append(opens[1:], True) | np.append(True, step[1:] != step[:-1])
    return np.sort(order[keep])


def chained_groups(doc: np.ndarray, first: np.ndarray, pos: np.ndarray, other: np.ndarray, k: int):
    """The chains of matches sorted by all four columns, a group for each ``doc`` and ``first``, as an Arrow batch; most groups
    are of one match, or of one diagonal, and are told apart for all groups at once."""
    import pyarrow as pa

    opens = np.append(True, (doc[1:] != doc[:-1]) | (first[1:] != first[:-1]))
    keep = opens | np.append(True, (pos[1:] != pos[:-1]) | (other[1:] != other[:-1]))
    group = (np.cumsum(opens) - 1)[keep]
    at = np.flatnonzero(keep)[thinned(pos[keep], other[keep], k, group)]
    doc, first, pos, other = doc[at], first[at], pos[at], other[at]
    cuts = np.append(np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (first[1:] != first[:-1]))), len(at))
    of, sizes, members, since = [], [], [], 0
    whole = whole_groups(pos, other, cuts, k)

    def as_they_are(a: int, b: int) -> None:
        if a < b:
            of.append(cuts[a:b])
            sizes.append(np.diff(cuts[a : b + 1]))
            members.append(np.arange(cuts[a], cuts[b]))

    for g in np.flatnonzero(~whole).tolist():
        as_they_are(since, g)
        since, low = g + 1, cuts[g]
        found = chains(pos[low : cuts[g + 1]], other[low : cuts[g + 1]], k)
        of.append(np.full(len(found), low))
        sizes.append(np.array([len(x) for x in found]))
        members.append(np.array([i for x in found for i in x]) + low)
    as_they_are(since, len(whole))
    of, members = np.concatenate(of), np.concatenate(members)
    offsets = pa.array(np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(x[members].astype(np.int32, copy=False))) for x in (pos, other)]
    return pa.RecordBatch.from_arrays([pa.array(doc[of]), pa.array(first[of]), *lists], names=["doc", "first", "pos", "other"])


def long_keys(words: np.ndarray, counts: np.ndarray, own: np.ndarray, of: np.ndarray, levels: tuple[int, ...]) -> tuple[np.ndarray, list]:
    """The hashes of the words from place ``own`` of text ``of`` on, as many as each of ``levels``, as Arrow arrays, null where the
    text is shorter; and which places have any. ``words`` are the hashes of all texts in a row, ``counts`` how many each has."""
    import pyarrow as pa

    some = own + levels[0] <= counts[of]
    own, of = own[some], of[some]
    start, keys, total = (np.cumsum(counts) - counts)[of] + own, [], np.zeros(len(own), np.uint64)
    last = max(0, len(words) - 1)
    with np.errstate(over="ignore"):
        for i in range(levels[-1]):
            # Beyond a text's end this adds words of another, only to hashes that are null.
            total += words[np.minimum(start + i, last)] * (PLACES[i % 64] * np.uint64(2 * (i // 64) + 1))
            if i + 1 in levels:
                keys.append(pa.array(mixed(total).view(np.int64), mask=own + i + 1 > counts[of]))
    return some, keys


def alike_enough(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, ends: tuple, k: int, min_words: int, min_identity: int) -> np.ndarray:
    """Of chains of one match, found by chance as a rule, those with enough equal words around it to be looked at.

    The match is at ``p`` of ``a`` and ``q`` of ``b``; ``ends`` are the bounds of the words of either range: from, to, from, to.
    """
    n, out = max(REACH, min_words), np.zeros(len(p), bool)
    back = np.minimum(np.minimum(p - ends[0], q - ends[2]), n)
    on = np.minimum(np.minimum(ends[1] - p, ends[3] - q), n + k)
    steps = np.arange(-n, n + k)
    for low in range(0, len(p), 4096):
        some = slice(low, low + 4096)
        inside = (steps >= -back[some, None]) & (steps < on[some, None])
        equal = a[np.where(inside, p[some, None] + steps, 0)] == b[np.where(inside, q[some, None] + steps, 0)]
        out[some] = 100 * (equal & inside).sum(axis=1) >= min_identity * min_words
    return out


def extended_rows(same: np.ndarray, sizes: np.ndarray, drop: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """``extended`` for many pairs of ranges: a row tells which words of a pair are equal, the first ``sizes`` of it count."""
    if not same.size:
        return np.zeros(len(same), np.int64), np.zeros(len(same), np.int64)
    score = np.cumsum(np.where(same, 1, -2).astype(np.int32), axis=1, dtype=np.int32)
    ended = (score < np.maximum.accumulate(np.maximum(score, 0), axis=1) - drop) | (np.arange(same.shape[1]) >= sizes[:, None])
    score[np.logical_or.accumulate(ended, axis=1)] = -1
    best = score.argmax(axis=1)
    rows = np.arange(len(same))
    some = score[rows, best] > 0
    return np.where(some, best + 1, 0), np.where(some, np.cumsum(same, axis=1, dtype=np.int32)[rows, best], 0)


def aligned_lone(a: np.ndarray, b: np.ndarray, p: np.ndarray, q: np.ndarray, ends: tuple, k: int, min_words: int, min_identity: int) -> list[np.ndarray]:
    """``aligned`` for chains of one match, as columns; places are in ``a`` and ``b``, and ``ends`` are the bounds of the words of either range."""
    out = []
    for low in range(0, len(p), 4096):
        (own, other), bounds = (x[low : low + 4096] for x in (p, q)), [x[low : low + 4096] for x in ends]
        sizes = np.minimum(bounds[1] - own, bounds[3] - other) - k, np.minimum(own - bounds[0], other - bounds[2])
        flanks = []
        for n, start, way in zip(sizes, (k, -1), (1, -1), strict=True):
            steps = np.arange(n.max())
            inside = steps < n[:, None]
            at = start + way * steps
            flanks.append((a[np.where(inside, own[:, None] + at, 0)] == b[np.where(inside, other[:, None] + at, 0)]) & inside)
        (right, same_right), (left, same_left) = (extended_rows(x, n) for x, n in zip(flanks, sizes, strict=True))
        same = k + same_left + same_right
        for i in np.flatnonzero(k + left + right < min_words).tolist():
            if best_ends := reached(flanks[1][i, : sizes[1][i]], flanks[0][i, : sizes[0][i]], k, k, k, min_words, min_identity):
                left[i], right[i], same[i] = best_ends
        out.append((own - left, own + k + right, other - left, other + k + right, same))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 5


def _words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows of an Arrow column of bytes, and from where to where each row has its own."""
    import pyarrow as pa

    if not len(column):
        return np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    words = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]].view(np.uint32) if bounds[-1] > bounds[0] else np.empty(0, np.uint32)
    bounds = (bounds - bounds[0]) // 4
    return words, bounds[:-1], bounds[1:]


def passages_of(batch, k: int, min_words: int, min_identity: int):
    """The passages that the chains of an Arrow batch make with the words beside them, as a batch. Most chains are of one match, and are aligned together."""
    import pyarrow as pa

    words, low, high = _words(batch.column("words"))
    others, other_low, other_high = _words(batch.column("other_words"))
    doc, first, start, other_start = (batch.column(c).to_numpy() for c in ("doc", "first", "from", "other_from"))
    sizes = batch.column("pos").value_lengths().to_numpy().astype(np.int64)
    ends = np.cumsum(sizes)
    pos, other = (batch.column(c).flatten().to_numpy().astype(np.int64) for c in ("pos", "other"))
    pos, other = pos - np.repeat(start, sizes), other - np.repeat(other_start, sizes)
    # Places of another text with this id may lie beyond its words.
    there = (pos[ends - 1] + k <= high - low) & (other[ends - 1] + k <= other_high - other_low)

    lone = np.flatnonzero(there & (sizes == 1))
    at = [pos[ends[lone] - 1] + low[lone], other[ends[lone] - 1] + other_low[lone], low[lone], high[lone], other_low[lone], other_high[lone]]
    some = alike_enough(words, others, at[0], at[1], at[2:], k, min_words, min_identity)
    lone, at = lone[some], [x[some] for x in at]
    found = aligned_lone(words, others, at[0], at[1], at[2:], k, min_words, min_identity)
    parts = [(lone, *(x - base[lone] for x, base in zip(found, (low, low, other_low, other_low), strict=False)), found[4])]
    for i in np.flatnonzero(there & (sizes > 1)).tolist():
        own = slice(ends[i] - sizes[i], ends[i])
        a, b = words[low[i] : high[i]], others[other_low[i] : other_high[i]]
        alignments = aligned(a, b, pos[own].tolist(), other[own].tolist(), k, min_identity, min_words)
        parts.append((np.full(len(alignments), i), *np.array(alignments, np.int64).reshape(-1, 5).T))
    row, begin, end, other_begin, other_end, equal = (np.concatenate(x) for x in zip(*parts, strict=True))
    keep = (end - begin >= min_words) & (100 * equal >= min_identity * np.maximum(end - begin, other_end - other_begin))
    row, begin, end, other_begin, other_end, equal = (x[keep] for x in (row, begin, end, other_begin, other_end, equal))
    columns = [doc[row], begin + start[row], end + start[row], first[row], other_begin + other_start[row], other_end + other_start[row], equal]
    names = ["doc", "start", "end", "first_doc", "first_start", "first_end", "equal_words"]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names=names)


def _packed(values: np.ndarray) -> bytes:
    """The bytes of ``values``, first bytes first, compressed: what the values share takes nearly no room."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _run_ends(sorted_values: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1, len(sorted_values))


DEALT = "bucket int, rest boolean, low long, seeds binary, docs binary, places binary"


def dealt_rows(seeds: np.ndarray, docs: np.ndarray, places: np.ndarray, buckets: int) -> list[dict]:
    """The places of seeds, packed for the bucket of each seed.

    Of a seed with more than ``FEW`` places here, the first ``FEW`` and the last go there, which tell that it is frequent,
    its first place, and whether it is in two documents; the others are ``rest`` and go to any bucket, so no task gets all places of a seed.
    """
    order = np.argsort(seeds, kind="stable")
    ends = _run_ends(seeds[order])
    starts = np.append(0, ends[:-1])
    there = np.ones(len(order), bool)
    for a, b in zip(*(x[ends - starts > FEW + 1] for x in (starts, ends)), strict=True):
        own = order[a:b]
        order[a:b] = own[np.lexsort((places[own], docs[own]))]
        there[a + FEW : b - 1] = False

    def row(at: np.ndarray, bucket: int, rest: bool) -> dict:
        low = int(docs[at].min())
        delta = np.diff(seeds[at], prepend=np.uint64(0))
        return {
            "bucket": bucket, "rest": rest, "low": low, "seeds": _packed(delta), "docs": _packed(docs[at] - low), "places": _packed(places[at])
        }

    out, sent, rest = [], order[there], order[~there]
    numbers = ((seeds[sent] >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    ends = _run_ends(numbers)
    for a, b in zip(np.append(0, ends[:-1]), ends, strict=True):
        out.append(row(sent[a:b], int(numbers[a]), False))
    if len(rest):
        out.append(row(rest, int(docs[rest[0]] + places[rest[0]]) % buckets, True))
    return out


GROUPED = "kind int, seed long, first long, other int, docs array<long>, places array<int>"
PAIRED, FREQUENT, REST, HOME = range(4)


def grouped_places(rows: list[dict]) -> list:
    """What a bucket's rows say of its seeds in two documents, as columns of ``GROUPED``: all places of those with up to
    ``FEW``, the places of the others with the first one, that one alone, and the rest of their places."""
    import pyarrow as pa

    out = []

    def add(kind: int, seeds, first, other, ends, docs, places) -> None:
        n = len(seeds)
        offsets = pa.array(np.append(0, ends).astype(np.int32))
        out.append(
            [pa.array(np.full(n, kind, np.int32)), pa.array(np.asarray(seeds, np.uint64).view(np.int64)), pa.array(first, pa.int64()), pa.array(other, pa.int32()),
             pa.ListArray.from_arrays(offsets, pa.array(docs)), pa.ListArray.from_arrays(offsets, pa.array(places))]
        )

    for rest in (False, True):
        own = [r for r in rows if r["rest"] == rest]
        if not own:
            continue
        seeds = np.concatenate([np.cumsum(_unpacked(r["seeds"], np.uint64), dtype=np.uint64) for r in own])
        docs = np.concatenate([_unpacked(r["docs"], np.int64) + r["low"] for r in own])
        places = np.concatenate([_unpacked(r["places"], np.int32) for r in own])
        order = np.argsort(seeds, kind="stable")
        seeds, docs, places = seeds[order], docs[order], places[order]
        ends = _run_ends(seeds)
        starts = np.append(0, ends[:-1])
        if rest:
            add(REST, seeds[starts], [None] * len(starts), [None] * len(starts), ends, docs, places)
            continue
        shared = np.minimum.reduceat(docs, starts) != np.maximum.reduceat(docs, starts)
        few = shared & (ends - starts <= FEW)
        inside = np.repeat(few, ends - starts)
        add(PAIRED, seeds[starts[few]], [None] * int(few.sum()), [None] * int(few.sum()), np.cumsum((ends - starts)[few]), docs[inside], places[inside])
        for a, b in zip(*(x[shared & ~few] for x in (starts, ends)), strict=True):
            first = docs[a:b].min()
            other = places[a:b][docs[a:b] == first].min()
            add(FREQUENT, seeds[a : a + 1], [first], [other], [b - a], docs[a:b], places[a:b])
            add(HOME, seeds[a : a + 1], [first], [other], [0], docs[:0], places[:0])
    return [pa.concat_arrays([columns[i] for columns in out]) for i in range(6)] if out else []


def matched_seeds(dealt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``matched`` gives them, from the rows of ``dealt_rows``: one exchange of packed rows."""

    def grouped(batches):
        import pyarrow as pa

        for group in groups(batches, 1):
            if columns := grouped_places(group.to_pylist()):
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "seed", "first", "other", "docs", "places"])

    at = stored(mapped(dealt.repartition("bucket").sortWithinPartitions("bucket"), grouped, GROUPED), release=True)
    place = F.arrays_zip(F.col("docs").alias("doc"), F.col("places").alias("pos"))
    pairs = at.where(F.col("kind") == PAIRED).select(place.alias("__all")).select(F.explode("__all").alias("__own"), "__all")
    pairs = pairs.select("__own", F.explode("__all").alias("__its")).where("__own.doc > __its.doc")
    few = pairs.select(F.col("__own.doc").alias("doc"), F.col("__its.doc").alias("first"), F.col("__own.pos").alias("pos"), F.col("__its.pos").alias("other"))
    rest = at.where(F.col("kind") == REST).select("seed", "docs", "places").join(at.where(F.col("kind") == HOME).select("seed", "first", "other"), "seed")
    frequent = at.where(F.col("kind") == FREQUENT).select("first", "other", "docs", "places").unionByName(rest.drop("seed"))
    many = frequent.select(F.explode(place).alias("__own"), "first", "other").select("__own.doc", "__own.pos", "first", "other")
    return few, many


def matched(places: DataFrame, seed: str) -> tuple[DataFrame, DataFrame]:
    """``(doc, first, pos, other)`` of seeds with up to ``FEW`` places, at all pairs of documents; and the places of
    the others, with the first one as ``first`` and ``other``. Seeds of one document have neither."""
    by = places.where(F.col(seed).isNotNull()).groupBy(F.col(seed).alias("__seed"))
    of = by.agg(F.count("*").alias("__n"), F.min(F.struct("doc", "pos")).alias("__home"), F.max("doc").alias("__last")).where("__home.doc <> __last")
    shared = stored(places.join(of.drop("__last"), F.col(seed) == F.col("__seed")).drop(seed), release=True)
    pairs = shared.where(F.col("__n") <= FEW).groupBy("__seed").agg(F.collect_list(F.struct("doc", "pos")).alias("__all"))
    pairs = pairs.select(F.explode("__all").alias("__own"), "__all").select("__own", F.explode("__all").alias("__its")).where("__own.doc > __its.doc")
    few = pairs.select(F.col("__own.doc").alias("doc"), F.col("__its.doc").alias("first"), F.col("__own.pos").alias("pos"), F.col("__its.pos").alias("other"))
    many = shared.where(F.col("__n") > FEW).withColumns({"first": F.col("__home.doc"), "other": F.col("__home.pos")}).drop("__seed", "__n", "__home")
    return few, many


def passages(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_words: int = MIN_WORDS,
    min_identity: int = MIN_IDENTITY,
    k: int = SEED,
    span: int = SPAN,
) -> DataFrame:
    """``(doc, start, end, first_doc, first_start, first_end, equal_words)``: words ``start`` to ``end`` of ``doc`` repeat those of ``first_doc``."""

    def seeded(batches):
        import pyarrow as pa

        schema = pa.schema([("bucket", pa.int32()), ("rest", pa.bool_()), ("low", pa.int64()), *((c, pa.binary()) for c in ("seeds", "docs", "places"))])
        held, size = [], 0

        def out():
            found = dealt_rows(*(np.concatenate(x) for x in zip(*held, strict=True)), buckets)
            held.clear()
            return pa.RecordBatch.from_pylist(found, schema)

        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                hashes, counts = word_hashes(piece.column("text"))
                for doc, n, end in zip(piece.column("doc").to_pylist(), counts.tolist(), np.cumsum(counts).tolist(), strict=True):
                    at, value = seeds(hashes[end - n : end], k, span)
                    if len(at):
                        held.append((value.view(np.uint64), np.full(len(at), doc, np.int64), at.astype(np.int32)))
                        size += len(at)
                if size >= HELD:
                    yield out()
                    size = 0
        if held:
            yield out()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where("doc is not null and text is not null")
    # Of a size that a task holds some of: sixteen for each partition of an exchange.
    buckets = 16 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few, many = matched_seeds(mapped(rows, seeded, DEALT))
    found, levels = [few, many.select("doc", "first", "pos", "other")], (*(n for n in LONGER if k < n < min_words), min_words)
    at = many.groupBy("doc").agg(F.collect_set("pos").alias("places"))

    def lengthened(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                words, counts = word_hashes(piece.column("text"))
                places = piece.column("places")
                own = places.flatten().to_numpy().astype(np.int64)
                of = np.repeat(np.arange(len(counts)), places.value_lengths().to_numpy())
                some, keys = long_keys(words, counts, own, of, levels)
                docs_ = piece.column("doc").to_numpy()[of[some]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_), pa.array(own[some].astype(np.int32)), *keys], names=["doc", "pos", *(f"key{i}" for i in range(len(levels)))]
                )

    left = stored(mapped(rows.join(at, "doc"), lengthened, "doc long, pos int, " + ", ".join(f"key{i} long" for i in range(len(levels)))), release=True)
    for i in range(len(levels)):
        few, many = matched(left, f"key{i}")
        found += [few, many.select("doc", "first", "pos", "other")]
        later = [f"key{j}" for j in range(i + 1, len(levels))]
        left = many.select("doc", "pos", *later)
    matches = found[0]
    for more in found[1:]:
        matches = matches.unionByName(more)
    matches = matches.where("doc <> first").repartition("doc", "first").sortWithinPartitions("doc", "first", "pos", "other")

    def chained(batches):
        for table, _ in runs(batches, 2):
            yield chained_groups(*(table.column(c).to_numpy() for c in ("doc", "first", "pos", "other")), k)

    joined_up = mapped(matches, chained, "doc long, first long, pos array<int>, other array<int>")

    def low(places: str):
        return F.greatest(F.lit(0), F.floor((F.element_at(places, 1) - max(REACH, min_words)) / STEP) * STEP).cast("int")

    def high(places: str):
        return (F.ceil((F.element_at(places, -1) + k + max(REACH, min_words)) / STEP) * STEP).cast("int")

    found = stored(joined_up.withColumns({"from": low("pos"), "to": high("pos"), "other_from": low("other"), "other_to": high("other")}), release=True)
    wanted = found.select("doc", "from", "to").unionByName(found.select(F.col("first").alias("doc"), F.col("other_from").alias("from"), F.col("other_to").alias("to")))
    wanted = wanted.distinct().groupBy("doc").agg(F.collect_list(F.struct("from", "to")).alias("ranges"))

    def cut(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                docs_, lows, highs, data = [], [], [], []
                hashes, counts = word_hashes(piece.column("text"))
                ends = np.cumsum(counts)
                words = hashes.astype(np.uint32)
                for doc, spans, n, end in zip(piece.column("doc").to_pylist(), piece.column("ranges").to_pylist(), counts, ends, strict=True):
                    for s in spans:
                        docs_.append(doc)
                        lows.append(s["from"])
                        highs.append(s["to"])
                        data.append(words[end - n : end][s["from"] : s["to"]].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs_, pa.int64()), pa.array(lows, pa.int32()), pa.array(highs, pa.int32()), pa.array(data, pa.binary())],
                    names=["doc", "from", "to", "words"],
                )

    parts = stored(mapped(rows.join(wanted, "doc"), cut, "doc long, from int, to int, words binary").distinct(), release=True)
    other = parts.select(
        F.col("doc").alias("first"), F.col("from").alias("other_from"), F.col("to").alias("other_to"), F.col("words").alias("other_words")
    )
    both = found.join(parts, ["doc", "from", "to"]).join(other, ["first", "other_from", "other_to"])

    def align(batches):
        for batch in batches:
            if batch.num_rows:
                yield passages_of(batch, k, min_words, min_identity)

    picked = both.select("doc", "first", "pos", "other", "from", "other_from", "words", "other_words")
    return mapped(picked, align, "doc long, start long, end long, first_doc long, first_start long, first_end long, equal_words long")


def fuzzy_passages(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``docs`` with ``n_words``, ``spans`` (of words that repeat an earlier document's), ``n_removed`` (words in them) and ``first_docs``."""
    found = passages(docs, text, doc_id, **options).groupBy(F.col("doc").alias("__doc")).agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__spans"), F.sort_array(F.collect_set("first_doc")).alias("__first")
    )
    empty = F.array().cast("array<struct<start: long, end: long>>")

    def joined(done, span):
        last = F.element_at(done, -1)
        touches = (F.size(done) > 0) & (span["start"] <= F.try_element_at(done, F.lit(-1))["end"])
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"))
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(span)))

    spans = F.aggregate(F.coalesce("__spans", empty), empty, joined)
    # Words are counted before rows move, so that texts move only where they are asked for.
    counted = docs.withColumn("n_words", F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long"))
    out = counted.join(found, F.col(doc_id).cast("long") == F.col("__doc"), "left")
    out = out.withColumns(
        {
            "spans": spans,
            "first_docs": F.coalesce("__first", F.array().cast("array<long>")),
        }
    ).drop("__doc", "__spans", "__first")
    return out.withColumn("n_removed", F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]))
