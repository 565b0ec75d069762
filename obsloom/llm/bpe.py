"""Byte-level BPE encoding and decoding through a lexicon automaton.

A text is cut into units: a run of other characters with one space before it, or white space, such
that the tokenizer's own pieces never cross a unit's border. The units of all documents are counted,
and the most frequent are merged once and compiled with their ids into a minimal acyclic transducer,
which is shipped as a file and mapped into memory by every worker. Encoding looks up the distinct units of
a few megabytes of text at once; units that the lexicon lacks are cut into pieces and merged exactly,
all pieces side by side, one best pair of each per round. The lexicon's size (a parameter) changes
the time, never the ids.

Defined results: null and empty text have no ids and decode to an empty text. The string of a special
token is that token, as in the tokenizer's default. Bytes that are not UTF-8 can only come from ids
given to :func:`decode`, and are replaced. Repeated rows are encoded alike. Columns of the input named
as a column of the result are replaced.
"""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.llm import automaton
from obsloom.llm.common import mapped, pieces, stored, with_columns

#: White space as the tokenizer's pattern knows it: the Unicode property.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
UNITS = re.compile(f" ?[^{BLANK}]+|[{BLANK}]+(?![^{BLANK}])|[{BLANK}]+")
#: The pieces of byte-level BPE within a unit (fixed value of the published tokenizer).
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNSEEN = np.int64(1) << 62


def byte_letters() -> list[str]:
    """The printable letter that byte-level BPE writes for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in letters:
            letters[b] = chr(extra)
            extra += 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """Merge ranks and token bytes of a byte-level BPE file, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            raw = json.load(f)
        ids, letters = raw["model"]["vocab"], byte_letters()
        back = {x: b for b, x in enumerate(letters)}
        self.first = np.array([ids[x] for x in letters], np.int64)
        keys, ranks, results = [], [], []
        for rank, pair in enumerate(raw["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            keys.append((ids[left] << 32) | ids[right])
            ranks.append(rank)
            results.append(ids[left + right])
        order = np.argsort(np.array(keys, np.int64))
        self.pairs = np.array(keys, np.int64)[order]
        self.ranks = np.array(ranks, np.int64)[order]
        self.results = np.array(results, np.int64)[order]
        self.once = len(set(results)) == len(results)
        self.special = {t["content"]: t["id"] for t in raw.get("added_tokens", [])}
        table = {i: bytes(back[c] for c in token) for token, i in ids.items()} | {i: s.encode() for s, i in self.special.items()}
        tokens = [table.get(i, b"") for i in range(max(table) + 1)]
        self.token_lengths = np.array([len(t) for t in tokens], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (``UNSEEN`` if there is none) and result of each pair."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.ranks[at], UNSEEN), self.results[at]

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``words`` in a row, and how many each has: pairs of each word's best rank merge per round."""
        lengths = np.array([len(w) for w in words], np.int64)
        ids = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_words = [], []
        rank = np.full(len(ids), UNSEEN)
        result = np.zeros(len(ids), np.int64)
        if len(ids) > 1:
            inside = np.flatnonzero(word[1:] == word[:-1])
            rank[inside], result[inside] = self.find(ids[inside], ids[inside + 1])
        while len(ids):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            sizes = np.diff(np.append(starts, len(ids)))
            best = np.minimum.reduceat(rank, starts)
            ended = np.repeat(best == UNSEEN, sizes)
            if ended.any():
                done_ids.append(ids[ended])
                done_words.append(word[ended])
                stay = ~ended
                ids, word, rank, result = ids[stay], word[stay], rank[stay], result[stay]
                if not len(ids):
                    break
                live = best != UNSEEN
                best, sizes = best[live], sizes[live]
                starts = np.cumsum(sizes) - sizes
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            if self.once:
                # No token has two pairs, so pairs with a token made now rank behind: all of a word's places merge
                # at once, every second one where they overlap.
                run = np.flatnonzero(np.concatenate([[True], hits[1:] != hits[:-1] + 1]))
                place = np.arange(len(hits)) - np.repeat(run, np.diff(np.append(run, len(hits))))
                at = hits[place % 2 == 0]
            else:
                at = hits[np.concatenate([[True], word[hits[1:]] != word[hits[:-1]]])]  # the leftmost of each word
            ids[at] = result[at]
            gone = np.zeros(len(ids), bool)
            gone[at + 1] = True
            stay = ~gone
            at = at - np.arange(len(at))  # one left out at every place before
            ids, word, rank, result = ids[stay], word[stay], rank[stay], result[stay]
            for i in (at, at[at > 0] - 1):
                pair = i[i + 1 < len(ids)]
                pair = pair[word[pair] == word[pair + 1]]
                rank[i], result[i] = UNSEEN, 0
                rank[pair], result[pair] = self.find(ids[pair], ids[pair + 1])
        ids, word = np.concatenate([*done_ids, ids]), np.concatenate([*done_words, word])
        order = np.argsort(word, kind="stable")
        return ids[order].astype(np.int32), np.bincount(word, minlength=len(words)).astype(np.int64)

    def units_to_ids(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all ``units`` in a row, and how many each has, without the lexicon."""
        import regex

        pattern = regex.compile(PIECES)
        cut = [[u] if u in self.special else pattern.findall(u) for u in units]
        known = {p: i for i, p in enumerate(dict.fromkeys(p for c in cut for p in c))}
        ids, lengths = self.merge([b"" if p in self.special else p.encode() for p in known])
        code = np.fromiter((known[p] for c in cut for p in c), np.int64)
        own = np.repeat(np.arange(len(units)), [len(c) for c in cut])
        flat = taken(ids, np.cumsum(lengths) - lengths, lengths, code)
        counts = np.bincount(own, weights=lengths[code], minlength=len(units)).astype(np.int64)
        special = [i for i, u in enumerate(units) if u in self.special]
        if special:
            starts = np.cumsum(counts)
            flat = np.insert(flat, [starts[i] for i in special], [self.special[units[i]] for i in special]).astype(np.int32)
            counts[special] = 1
        return flat, counts

    def text_units(self, text: str) -> list[str]:
        for s in self.special:
            if s in text:
                return [u for i, part in enumerate(text.split(s)) for u in ([s] if i else []) + self.text_units(part)]
        return UNITS.findall(text)

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> list[str]:
        """Texts of rows of ids; ``ends`` are the rows' ends in ``ids``."""
        data = taken(self.token_bytes, self.token_starts, self.token_lengths, ids).tobytes()
        cuts = np.concatenate([[0], np.cumsum(self.token_lengths[ids])])[np.concatenate([[0], ends])]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def taken(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The ranges ``which`` of ``values``, one after the other."""
    n = lengths[which]
    ends = np.cumsum(n)
    return values[np.repeat(starts[which] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def unit_counts(docs: DataFrame, text: str, vocab: str, entries: int = 200_000) -> DataFrame:
    """``(unit, n)``: how often each unit is found in all texts."""

    def run(batches):
        import pyarrow as pa

        words, counts = vocabulary(vocab), Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["unit", "n"])

        for batch in batches:
            for piece in pieces(batch, text, 4 << 20):
                for t in piece.column(text).to_pylist():
                    counts.update(words.text_units(t or ""))
                if len(counts) > entries:
                    yield out()
                    counts.clear()
        if counts:
            yield out()

    return mapped(docs.select(text), run, "unit string, n long").groupBy("unit").agg(F.sum("n").alias("n"))


def frequent_units(docs: DataFrame, vocab: str, text: str, max_words: int, max_bytes: int) -> list[str]:
    """The most frequent units, ``max_words`` at most, in the order of their bytes.

    The count from which units are taken is read off a histogram of counts, a few hundred rows at any
    size, so that no task sends the driver more than its share of the result.
    """
    counted = stored(unit_counts(docs, text, vocab).where((F.col("n") > 1) & (F.octet_length("unit") <= max_bytes)))
    bins = counted.groupBy(F.floor(F.log("n") * 32).alias("bin")).agg(F.count("*").alias("units"), F.min("n").alias("n"))
    taken_, least = 0, None
    for r in sorted(bins.collect(), key=lambda r: -r["bin"]):
        taken_ += r["units"]
        if taken_ > max_words:
            break
        least = r["n"]
    if least is None:
        return []
    return sorted((r["unit"] for r in counted.where(F.col("n") >= least).select("unit").collect()), key=str.encode)


def build_lexicon(docs: DataFrame, vocab: str, text: str = "text", max_words: int = 65_536, max_bytes: int = 64) -> str:
    """Compile the most frequent units of at most ``max_bytes`` bytes; the name of the file shipped with the session."""
    units = frequent_units(docs, vocab, text, max_words, max_bytes)
    ids, lengths = vocabulary(vocab).units_to_ids(units)
    outputs = np.split(ids, np.cumsum(lengths)[:-1]) if units else []
    path = os.path.join(tempfile.mkdtemp(), f"lexicon-{uuid.uuid4().hex}.bin")
    automaton.save(automaton.build([u.encode() for u in units], (x.tolist() for x in outputs)), path)
    docs.sparkSession.sparkContext.addFile(path)
    return os.path.basename(path)


def encoder(vocab: str, lexicon: str, decoded: bool):
    """A function from texts to their ids, and to what these decode to."""
    import pyarrow as pa
    from pyspark import SparkFiles

    words, arrays = vocabulary(vocab), automaton.load(SparkFiles.get(lexicon))

    def columns(texts: list[str]) -> list:
        cut = [words.text_units(t) for t in texts]
        sizes = np.array([len(c) for c in cut], np.int64)
        known = {u: i for i, u in enumerate(dict.fromkeys(u for c in cut for u in c))}
        code = np.fromiter((known[u] for c in cut for u in c), np.int64, int(sizes.sum()))
        del cut
        units = list(known)
        raw = [u.encode() for u in units]
        lengths = np.array([len(r) for r in raw], np.int64)
        rank = automaton.ranks(arrays, np.frombuffer(b"".join(raw), np.uint8), np.cumsum(lengths) - lengths, lengths)
        seen = rank >= 0
        missing = np.flatnonzero(~seen)
        new_ids, new_lengths = words.units_to_ids([units[i] for i in missing]) if len(missing) else (np.empty(0, np.int32), np.empty(0, np.int64))
        table = np.concatenate([arrays["outputs"], new_ids])
        starts, n = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        starts[seen], n[seen] = arrays["offsets"][rank[seen]], np.diff(arrays["offsets"])[rank[seen]]
        starts[missing], n[missing] = len(arrays["outputs"]) + np.cumsum(new_lengths) - new_lengths, new_lengths
        ids = taken(table, starts, n, code).astype(np.int32)
        per_unit = np.concatenate([[0], np.cumsum(n[code])])
        ends = per_unit[np.cumsum(sizes)]
        offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
        out = [pa.ListArray.from_arrays(offsets, pa.array(ids))]
        return [*out, pa.array(words.decode(ids, ends), pa.string())] if decoded else out

    return columns


def encode(docs: DataFrame, vocab: str, lexicon: str | None = None, text: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with ``ids`` and, if asked, ``decoded``: the text that the ids decode to.

    ``vocab`` is the tokenizer's file, at the same path on every machine; ``lexicon`` one of
    :func:`build_lexicon`, by default that of ``docs``.
    """
    lexicon = lexicon or build_lexicon(docs, vocab, text)
    return with_columns(docs, text, "ids array<int>" + ", decoded string" * decoded, encoder, vocab, lexicon, decoded)


def decode(rows: DataFrame, vocab: str, ids: str = "ids") -> DataFrame:
    """``rows`` with ``decoded``; null ids decode to an empty text."""
    import pyarrow as pa
    from pyspark.sql.types import StringType, StructField, StructType

    old = [f for f in rows.schema if f.name != "decoded"]

    def run(batches):
        words = vocabulary(vocab)
        for batch in batches:
            lists = [x or [] for x in batch.column(ids).to_pylist()]
            flat = np.array([i for x in lists for i in x], np.int64)
            texts = words.decode(flat, np.cumsum([len(x) for x in lists]).astype(np.int64))
            names = [f.name for f in old]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, "decoded"])

    return mapped(rows, run, StructType([*old, StructField("decoded", StringType())]))
