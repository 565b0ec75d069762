"""Substrings that start twice, by bounded interval expansion on Burrows-Wheeler transforms.

A window of ``length`` bytes is repeated if the same bytes also start anywhere else. Equal windows have
equal *anchors*: of the 64-byte strings in a window, the first one of least hash. So

1. every text gives the hashes of its windows' anchors; those found once in all documents cannot
   belong to a repeated window;
2. around the others, each run of windows with one anchor is cut out as a context. Equal contexts are
   one from here on, with a count: a context found twice is repeated as a whole;
3. different contexts of an anchor are put into one block of a few megabytes, with other anchors'. On
   the block's Burrows-Wheeler transform, intervals of suffixes with a common prefix are extended
   backwards, breadth first. Extending all prefixes of length l finds every border between neighbours
   whose longest common prefix is l, so common prefixes come by increasing value, and after ``length``
   levels the borders not yet found are those of repeated windows. An anchor whose contexts together are
   larger than a block would allow is counted by 128-bit hashes of its windows instead;
4. repeated windows go back from contexts to documents, and what they cover is removed.

No task holds more than a block, and a passage in a third of all documents is one context per
variant of its surroundings.

Defined results: null text is empty, and nothing is removed from texts shorter than ``length``. Rows
that are equal in id and text are found twice, like any copies. Ids may be null or repeated.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.llm.common import groups, mapped, pieces, stored
from obsloom.llm.minhash import mixed

LENGTH = 400
ANCHOR = 64
BLOCK_BYTES = 2 << 20
SEGMENT = 2 << 20
_RANDOM = np.random.default_rng(64_400)
LETTERS = _RANDOM.integers(0, 1 << 63, (2, 256), np.uint64) * np.uint64(2) + np.uint64(1)
STEPS = _RANDOM.integers(0, 1 << 63, (2, 64), np.uint64) * np.uint64(2) + np.uint64(1)


def rolled(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """The 64-bit hash of every string of ``length`` bytes, from those of half the length."""
    with np.errstate(over="ignore"):
        power = LETTERS[seed][data]
        size, out, done, level = 1, None, 0, 0
        while True:
            if length & size:
                if out is None:
                    out = power.copy()
                else:
                    n = min(len(out), len(power) - done)
                    out = out[:n] * STEPS[seed][level] + power[done : done + n]
                done += size
            size *= 2
            if size > length:
                return mixed(out)
            level += 1
            power = power[: -size // 2 or None] * STEPS[seed][32 + level] + power[size // 2 :]


def least(values: np.ndarray, span: int) -> np.ndarray:
    """The position of the first least value among each ``span`` values in a row."""
    at = np.arange(len(values), dtype=np.int32)
    size = 1
    while size * 2 <= span:
        first = values[:-size] <= values[size:]
        at = np.where(first, at[:-size], at[size:])
        values = np.where(first, values[:-size], values[size:])
        size *= 2
    if size < span:
        shift = span - size
        first = values[:-shift] <= values[shift:]
        at = np.where(first, at[:-shift], at[shift:])
    return at


def segments(texts: list[bytes], length: int):
    """Pieces of the texts to work on together, ``(data, text, start in text, start in data, windows)``."""
    held, size = [], 0
    for i, t in enumerate(texts):
        for start in range(0, max(0, len(t) - length + 1), SEGMENT):
            part = t[start : start + SEGMENT + length - 1]
            held.append((i, start, size, part))
            size += len(part)
            if size >= SEGMENT:
                yield np.frombuffer(b"".join(h[3] for h in held), np.uint8), held
                held, size = [], 0
    if held:
        yield np.frombuffer(b"".join(h[3] for h in held), np.uint8), held


def contexts(texts: list[bytes], length: int, anchor: int = ANCHOR):
    """Runs of windows with one anchor: ``(text, first window, last window, hash)`` as arrays, for part of the texts at a time."""
    for data, held in segments(texts, length):
        hashes = rolled(data, anchor)
        at = least(hashes, length - anchor + 1)
        where = []
        for i, offset, place, part in held:
            windows = at[place : place + len(part) - length + 1]
            changes = np.concatenate([[0], np.flatnonzero(windows[1:] != windows[:-1]) + 1])
            where.append((i, offset - place, place + np.append(changes, len(windows))))
        text = np.concatenate([np.full(len(b) - 1, i) for i, _, b in where])
        shift = np.concatenate([np.full(len(b) - 1, s) for _, s, b in where])
        first = np.concatenate([b[:-1] for _, _, b in where])
        last = np.concatenate([b[1:] - 1 for _, _, b in where])
        yield text, first + shift, last + shift, hashes[at[first]].view(np.int64)


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks of an array of small numbers, by doubling the sorted length of what is not yet unique."""
    n, width = len(text), 7
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(width, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = (key << 9) | padded[i : i + n]
    sa = np.argsort(key, kind="stable")
    ordered = key[sa]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))  # the place of the first of its kind
    size = width
    alone = new & np.append(new[1:], True)
    todo = np.flatnonzero(~alone)
    while len(todo):
        at = sa[todo]
        behind = np.where(at + size < n, rank[np.minimum(at + size, n - 1)] + 1, 0)
        group = rank[at]
        order = np.argsort(group * (n + 1) + behind, kind="stable")
        at, group, behind = at[order], group[order], behind[order]
        sa[todo] = at
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])])
        rank[at] = np.maximum.accumulate(np.where(new, todo, 0))
        alone = new & np.append(new[1:], True)
        todo = todo[~alone]
        size *= 2
    return sa, rank


def shared_starts(text: np.ndarray, length: int) -> np.ndarray:
    """Which positions of ``text`` start a string of ``length`` that also starts elsewhere and has no 0 in it.

    ``text`` holds numbers from 0 to 256; 0 separates the strings it consists of.
    """
    n = len(text)
    sa, rank = suffix_array(text)
    before = text[sa - 1]  # the Burrows-Wheeler transform
    back = rank[sa - 1]  # where the suffix is that is longer by this letter
    change = np.concatenate([[True], before[1:] != before[:-1]])
    runs = np.append(np.flatnonzero(change), n)
    run = np.cumsum(change) - 1
    border = np.zeros(n + 1, bool)
    border[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for level in range(length):
        if not len(low):
            break
        first, last = run[low], run[high - 1]
        count = last - first + 1
        own = np.repeat(np.arange(len(low)), count)
        which = np.arange(len(own)) - np.repeat(np.cumsum(count) - count - first, count)
        start, stop = np.maximum(runs[which], low[own]), np.minimum(runs[which + 1], high[own])
        letter = before[start].astype(np.int64)
        if level:  # nothing with a separator inside is of use
            some = letter > 0
            own, start, stop, letter = own[some], start[some], stop[some], letter[some]
        key = own * 512 + letter
        order = np.argsort(key, kind="stable")
        key, start, stop = key[order], start[order], stop[order]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
        tail = np.append(edge[1:], len(key)) - 1 if len(key) else edge
        low, high = back[start[edge]], back[stop[tail] - 1] + 1
        if not level:  # the last separator has no letter behind it, so its own step back is out of order
            low, high = np.where(key[edge] == 0, 0, low), np.where(key[edge] == 0, (text == 0).sum(), high)
        new = ~border[high]
        low, high = low[new], high[new]
        border[high] = True
    shared = ~border[:n]
    twice = shared | np.append(shared[1:], False)
    starts = np.zeros(n, bool)
    starts[sa[twice]] = True
    zeros = np.append(np.flatnonzero(text == 0), n)
    room = zeros[np.searchsorted(zeros, np.arange(n))] - np.arange(n)
    return starts & (room >= length)


def ranges(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """What windows at sorted ``starts`` cover."""
    if not len(starts):
        return []
    cut = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist(), strict=True))


def _anchors(rows: DataFrame, length: int) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                keys = piece.column("row").to_numpy()
                for text, _, _, anchor in contexts([t.encode() for t in piece.column("text").to_pylist()], length):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[text]), pa.array(anchor)], names=["row", "anchor"])

    return mapped(rows.select("row", "text"), run, "row long, anchor long")


def _contexts(rows: DataFrame, length: int) -> DataFrame:
    """``(row, doc, start, context, anchor, digest)`` of the runs whose anchor is in the row's ``anchors``."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                texts = [t.encode() for t in piece.column("text").to_pylist()]
                wanted = [np.array(a, np.int64) for a in piece.column("anchors").to_pylist()]
                for text, first, last, anchor in contexts(texts, length):
                    keep = np.zeros(len(text), bool)
                    for i in np.unique(text):
                        own = np.flatnonzero(text == i)
                        keep[own] = np.isin(anchor[own], wanted[i])
                    kept = np.flatnonzero(keep)
                    for some in np.split(kept, range(4096, len(kept), 4096)):  # a text of one letter has a context for each window
                        own, at = pa.array(text[some]), first[some]
                        parts = [texts[t][a : b + length] for t, a, b in zip(text[some].tolist(), at.tolist(), last[some].tolist(), strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [
                                piece.column("row").take(own), piece.column("doc").take(own), pa.array(at.astype(np.int64)),
                                pa.array(parts, pa.binary()), pa.array(anchor[some]), pa.array([xxhash.xxh3_128_digest(p) for p in parts], pa.binary()),
                            ],
                            names=["row", "doc", "start", "context", "anchor", "digest"],
                        )

    return mapped(rows, run, "row long, doc long, start long, context binary, anchor long, digest binary")


RANGES = "digest binary, ranges array<struct<a: long, b: long>>"


def _expanded(blocks: DataFrame, length: int) -> DataFrame:
    """Repeated ranges of the contexts in each block."""

    def run(batches):
        import pyarrow as pa

        for group in groups(batches, 1):
            parts = group.column("context").to_pylist()
            sizes = np.array([len(p) + 1 for p in parts])
            text = np.zeros(int(sizes.sum()), np.int16)
            ends = np.cumsum(sizes)
            inside = np.ones(len(text), bool)
            inside[ends - 1] = False
            text[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int16) + 1
            starts = np.flatnonzero(shared_starts(text, length))
            cuts = np.searchsorted(starts, ends)
            digests, found = [], []
            for digest, size, end, a, b in zip(group.column("digest").to_pylist(), sizes, ends, np.append(0, cuts[:-1]), cuts, strict=True):
                if b > a:
                    digests.append(digest)
                    found.append([{"a": x, "b": y} for x, y in ranges(starts[a:b] - (end - size), length)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(digests, pa.binary()), pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], names=["digest", "ranges"]
            )

    return mapped(blocks.select("block", "digest", "context"), run, RANGES)


def _counted(hot: DataFrame, length: int) -> DataFrame:
    """The same for contexts whose anchor has too many for a block: by hashes of all their windows."""

    def windows(batches):
        import pyarrow as pa

        for batch in batches:
            digests = batch.column("digest")
            for i, context in enumerate(batch.column("context").to_pylist()):
                data = np.frombuffer(context, np.uint8)
                h1, h2 = (rolled(data, length, seed).view(np.int64) for seed in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [digests.take(pa.array([i] * len(h1))), pa.array(np.arange(len(h1))), pa.array(h1), pa.array(h2)], names=["digest", "start", "h1", "h2"]
                )

    def covered(batches):
        import pyarrow as pa

        for batch in batches:
            found = [[{"a": x, "b": y} for x, y in ranges(np.array(s, np.int64), length)] for s in batch.column("starts").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))], names=["digest", "ranges"]
            )

    rows = stored(mapped(hot.select("digest", "context"), windows, "digest binary, start long, h1 long, h2 long"))
    twice = rows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    starts = rows.join(twice, ["h1", "h2"]).groupBy("digest").agg(F.sort_array(F.collect_list("start")).alias("starts"))
    return mapped(starts, covered, RANGES)


def repeated_substrings(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``spans`` (of bytes, removed), ``n_removed`` and ``kept`` (the bytes left)."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), body.alias("text")).withColumn("row", F.xxhash64("doc", "text"))
    long_rows = rows.where(F.octet_length("text") >= length)
    anchors = stored(_anchors(long_rows, length))
    twice = anchors.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    wanted = anchors.join(twice, "anchor").groupBy("row").agg(F.collect_set("anchor").alias("anchors"))
    found = stored(_contexts(long_rows.join(wanted, "row"), length))
    kinds = found.groupBy("digest", "anchor").agg(F.count("*").alias("n"), F.first("context").alias("context"))
    kinds = stored(kinds.withColumn("size", F.length("context").cast("long")))
    sizes = kinds.groupBy("anchor").agg(F.sum("size").alias("bytes"), F.count("*").alias("kinds")).where("kinds > 1").select("anchor", "bytes")
    mixed_kinds = kinds.join(sizes, "anchor")
    total = sizes.where(F.col("bytes") <= 2 * block_bytes).agg(F.sum("bytes")).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    in_blocks = mixed_kinds.where(F.col("bytes") <= 2 * block_bytes).withColumn("block", F.pmod(F.xxhash64("anchor"), F.lit(n_blocks)))
    in_blocks = in_blocks.select("block", "digest", "context").repartition(n_blocks, "block").sortWithinPartitions("block")
    hot = mixed_kinds.where(F.col("bytes") > 2 * block_bytes)
    some = stored(_expanded(in_blocks, length).unionByName(_counted(hot, length)))
    whole = kinds.where("n > 1").select("digest", F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b"))).alias("ranges"))
    marks = whole.unionByName(some.join(whole.select("digest"), "digest", "left_anti"))
    at = F.struct((F.col("start") + F.col("range.a")).alias("a"), (F.col("start") + F.col("range.b")).alias("b"))
    spans = found.select("row", "doc", "start", "digest").join(marks, "digest").select("row", "doc", "start", F.explode("ranges").alias("range"))
    spans = spans.groupBy(F.col("row").alias("__row"), F.col("doc").alias("__doc")).agg(F.sort_array(F.collect_set(at)).alias("marks"))
    joined = rows.join(spans, (F.col("row") == F.col("__row")) & F.col("doc").eqNullSafe(F.col("__doc")), "left")
    return _removed(joined.select("doc", "text", "marks"), doc_id)


def _removed(rows: DataFrame, doc_id: str) -> DataFrame:
    def run(batches):
        import pyarrow as pa

        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                n_bytes, spans, removed, kept = [], [], [], []
                for text, marks in zip(piece.column("text").to_pylist(), piece.column("marks").to_pylist(), strict=True):
                    data, merged = text.encode(), []
                    for m in marks or ():
                        if merged and m["a"] <= merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], m["b"])
                        else:
                            merged.append([m["a"], m["b"]])
                    edges = [0, *(x for m in merged for x in m), len(data)]
                    n_bytes.append(len(data))
                    spans.append([{"start": a, "end": b} for a, b in merged])
                    removed.append(sum(b - a for a, b in merged))
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc"), pa.array(n_bytes, pa.int64()), pa.array(spans, kind), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                    names=[doc_id, "n_bytes", "spans", "n_removed", "kept"],
                )

    return mapped(rows, run, f"`{doc_id}` long, n_bytes long, spans array<struct<start: long, end: long>>, n_removed long, kept binary")
