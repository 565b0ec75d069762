"""Scoring texts with a small causal self-attention model over subword ids.

1. Lower-cased words become subword ids of a published byte-level vocabulary. Texts are stored in blocks
   of about 12 MB: the block's distinct words with their ids and counts in training documents, and each
   text as numbers of these words.
2. Word counts are summed over all blocks beside the blocks that have the word, and sent back to these, so neither
   counting nor scoring holds the corpus' vocabulary anywhere. Counts of ids are summed too; the frequent
   ones are classes of their own, the others share classes.
3. The network (numpy) reads the ids before a place and predicts the next one: embeddings of ids and
   places, one head of causal self-attention added to them, a softmax over classes and one over the ids
   of the class, both from the same hidden state. There are as many classes as give a place the fewest
   logits by the counts. Every task trains on the windows of the training texts
   in its blocks, each once over all ``rounds`` (``train_every`` above 1 takes a share); the blocks' weights
   are averaged by their windows, in a tree, after each of ``rounds``. Windows are gathered a step at a time.
4. For scoring, windows of ``WINDOW`` ids overlap such that each id is scored once, with the
   ids of the window before it; windows go through the network in batches with a mask. A text's score is
   the sum of the network's log-probabilities of its ids and its end, known words or not. Word counts
   make ``base_score`` and ``n_known`` only.

Defined results: null and empty texts are one end token. A document is held out of training by the
CRC-32 of its id as a text; one without an id trains. Repeated rows are scored alike, and each of them
trains. Without any training text all counts are 0.
A word of more than 256 bytes is cut into parts of that size before it is merged, so its ids, and with them
``score``, may differ from those of the vocabulary; the counts and ``base_score`` take it whole.
"""

from __future__ import annotations

import base64
import zlib
from array import array
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from obsloom.llm.common import groups, mapped, pieces, stored

VOCABULARY = 50_257
END = 50_256
CLASSES = 256  # at most
READ_SINGLES, READ_CLASSES = 960, 1024
WINDOW, SCORED, WIDTH = 32, 24, 16
BATCH, LEARN_BATCH = 128, 256
PLACED = 1 << 16  # words whose ids are placed at once
INNER = 1 << 17  # places times ids of a class that are scored at once
START = READ_CLASSES  # what stands before a text


@lru_cache(maxsize=1)
def _merger(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("subwords", pat_str=r"[^\s]+|\s+", mergeable_ranks=ranks, special_tokens={})._encode_single_piece


def _pack(values: np.ndarray) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values).tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


BLOCK = "block long, docs array<long>, held array<boolean>, sizes array<int>, text binary, words string, counts binary, lengths binary, ids binary"


def blocks(docs: DataFrame, vocab: str, text: str, doc_id: str, fold: int, folds: int, block_bytes: int) -> DataFrame:
    """Texts as numbers of the block's words; ``counts`` are those in training documents."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        merge, number = _merger(vocab), 0
        known: dict[bytes, int] = {}
        cache: dict[bytes, list[int]] = {}
        ids, held, parts, size = [], [], [], 0

        def out():
            nonlocal number, size
            words, sizes = list(known), [len(p) for p in parts]
            train = np.concatenate([p for p, h in zip(parts, held, strict=True) if not h] or [np.empty(0, np.uint32)])
            # Very long words go in parts, as merging takes more than the time in proportion.
            lengths, subwords = array("I"), array("H")
            for w in words:
                if (found := cache.get(w)) is None:
                    found = merge(b" " + w) if len(w) <= 256 else [i for a in range(0, len(w), 256) for i in merge(b" " * (not a) + w[a : a + 256])]
                    if len(cache) < 150_000 and len(w) < 20:  # frequent words come early
                        cache[w] = found
                lengths.append(len(found))
                subwords.extend(found)
            row = {
                "block": (TaskContext.get().partitionId() << 24) + number,
                "docs": list(ids), "held": list(held), "sizes": sizes, "text": _pack(np.concatenate(parts)),
                "words": b" ".join(words).decode("utf-8", "replace"), "counts": _pack(np.bincount(train, minlength=len(words)).astype(np.int64)),
                "lengths": _pack(np.frombuffer(lengths, np.uint32)), "ids": _pack(np.frombuffer(subwords, np.uint16)),
            }
            number += 1
            for x in (known, ids, held, parts):
                x.clear()
            size = 0
            return pa.RecordBatch.from_pylist([row], schema)

        binary = ("text", "counts", "lengths", "ids")
        schema = pa.schema(
            [("block", pa.int64()), ("docs", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())), (binary[0], pa.binary()),
             ("words", pa.string()), *[(b, pa.binary()) for b in binary[1:]]]
        )
        for batch in batches:
            for piece in pieces(batch, "text", 1 << 20):
                for doc, t in zip(piece.column("doc").to_pylist(), piece.column("text").to_pylist(), strict=True):
                    raw = (t or "").encode().lower()
                    parts.append(np.array([known.setdefault(w, len(known)) for w in raw.split()], np.uint32))
                    ids.append(doc)
                    held.append(zlib.crc32(b"" if doc is None else str(doc).encode()) % folds == fold)
                    size += len(raw) + 64
                    if size >= block_bytes:
                        yield out()
        if ids:
            yield out()

    picked = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    return mapped(picked, run, BLOCK)


def _words(stored_blocks: DataFrame) -> DataFrame:
    """``(word, block, i, n)``: the words of every block, with their counts in training documents."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for block, words, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "words", "counts")), strict=True):
                words, counts = words.split(" ") if words else [], _unpack(counts, np.int64)
                for at in range(0, len(words), 50_000):
                    some = words[at : at + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, pa.string()), pa.array([block] * len(some), pa.int64()), pa.array(np.arange(at, at + len(some), dtype=np.int32)),
                         pa.array(counts[at : at + 50_000])], names=["word", "block", "i", "n"]
                    )

    return mapped(stored_blocks.select("block", "words", "counts"), run, "word string, block long, i int, n long")


def word_counts(words: DataFrame) -> DataFrame:
    """``(block, i, c, first)``: each block's words with their counts over all blocks, without those found in no training document.

    ``first`` marks one row of each word. Words move once; a word has at most one row of each block.
    """
    by_word = W.partitionBy("word").orderBy("block", "i")
    everywhere = by_word.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    counted = words.select("block", "i", F.sum("n").over(everywhere).alias("c"), (F.row_number().over(by_word) == 1).alias("first"))
    return counted.where("c > 0")


def _id_counts(stored_blocks: DataFrame) -> np.ndarray:
    """How often each id is found in training documents."""

    def run(batches):
        import pyarrow as pa

        total = np.zeros(VOCABULARY)
        for batch in batches:
            for r in batch.to_pylist():
                lengths, counts = _unpack(r["lengths"], np.uint32), _unpack(r["counts"], np.int64)
                total += np.bincount(_unpack(r["ids"], np.uint16), np.repeat(counts, lengths), VOCABULARY)
                total[END] += len(r["held"]) - sum(r["held"])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], names=["id", "n"])

    out = np.zeros(VOCABULARY)
    rows = mapped(stored_blocks.select("held", "counts", "lengths", "ids"), run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for r in rows.collect():  # bounded by the vocabulary
        out[r["id"]] = r["n"]
    return out


def classes(counts: np.ndarray, n: int, singles: int) -> np.ndarray:
    """The class of each id: the most frequent alone, the others in classes of about equal weight."""
    order = np.argsort(-counts, kind="stable")
    out = np.zeros(len(counts), np.int64)
    out[order[:singles]] = np.arange(singles)
    rest = order[singles:]
    weight = np.cumsum(counts[rest] + 0.5)
    out[rest] = singles + np.minimum((weight / weight[-1] * (n - singles)).astype(np.int64), n - singles - 1)
    return out


def logits(counts: np.ndarray, n: int, kinds: np.ndarray) -> float:
    """How many logits a place has in the mean over ``counts``: those of the classes, and of the ids in the id's class."""
    size = np.bincount(kinds, minlength=n)
    share = np.bincount(kinds, counts + 0.5, n)
    return n + float((share * np.where(size > 1, size, 0)).sum() / share.sum())


def fitted(counts: np.ndarray) -> np.ndarray:
    """The class of each id, in as many classes, a quarter of one id, as give a place the fewest logits.

    By the roots of the counts, frequent ids are in classes of few, and rare ones not all in the last. However
    small the counts, what all ids get in advance is a fifth of that.
    """
    roots = np.sqrt(counts)
    roots *= 2.5 * len(roots) / max(1.0, roots.sum())
    tried = [(n, classes(roots, n, n // 4)) for n in (24, 32, 48, 64, 96, 128, 192, CLASSES)]
    return min(tried, key=lambda t: logits(counts, *t))[1].astype(np.int16)


def _sums(t: np.ndarray) -> np.ndarray:
    """Of the rows of ``t``; a product takes less time than the sum of many short rows."""
    return t @ np.ones(t.shape[1], np.float32)


def _exp(t: np.ndarray, low: float | None = -60, high: float = 60) -> np.ndarray:
    """``t``, in place, as powers of e, its values held between ``low`` and ``high``."""
    np.minimum(t, np.float32(high), out=t)
    if low is not None:
        np.maximum(t, np.float32(low), out=t)
    return np.exp(t, out=t)


def _picked(hidden: np.ndarray, w: np.ndarray, bias: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The log-probability of each row's ``column`` by the logits ``hidden @ w + bias``."""
    t = hidden @ w
    t += bias
    _exp(t)
    return np.log(t.reshape(-1)[np.arange(len(t)) * t.shape[1] + column] / _sums(t))


def _neighbours(inner: list[tuple]) -> list[tuple]:
    """Gradients of classes whose rows follow each other, together."""
    cuts = [0, *(i for i in range(1, len(inner)) if inner[i][0] != inner[i - 1][1]), len(inner)]
    some = [inner[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True) if b > a]
    return [(own[0][0], own[-1][1], *(np.concatenate([g[i] for g in own]) for i in (2, 3))) for own in some]


class Model:
    """The network: ``weights`` by name, and the classes of ids."""

    def __init__(self, counts: np.ndarray, seed: int = 5) -> None:
        self.read = classes(counts, READ_CLASSES, READ_SINGLES).astype(np.int32)
        self.written = fitted(counts)
        share, n = counts + 0.5, int(self.written.max()) + 1
        mass = np.bincount(self.written, share, n)
        by_class = np.argsort(self.written, kind="stable")
        self.slot = np.empty(VOCABULARY, np.int32)  # an id's row in I and i, where a class's ids are neighbours
        self.slot[by_class] = np.arange(VOCABULARY)
        self.edges = np.searchsorted(self.written[by_class], np.arange(n + 1))
        random = np.random.default_rng(seed)

        def drawn(*shape: int, scale: float) -> np.ndarray:
            return (random.standard_normal(shape) * scale).astype(np.float32)

        d = WIDTH
        self.weights = {
            "E": drawn(READ_CLASSES + 1, d, scale=0.5), "P": drawn(WINDOW, d, scale=0.1),
            "Q": drawn(d, d, scale=d**-0.5), "K": drawn(d, d, scale=d**-0.5), "V": drawn(d, d, scale=d**-0.5),
            "O": drawn(d, n, scale=0.1), "o": np.log(np.maximum(mass, 1e-9) / mass.sum()).astype(np.float32),
            "I": drawn(VOCABULARY, d, scale=0.1), "i": np.log(share / mass[self.written])[by_class].astype(np.float32),
        }

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights.values()])

    def put(self, flat: np.ndarray) -> None:
        at = 0
        for name, w in self.weights.items():
            self.weights[name] = flat[at : at + w.size].reshape(w.shape).astype(np.float32)
            at += w.size

    def inner(self, ids: np.ndarray):
        """The order of the places by the class of their ``ids``, and the pieces of it by class: start, end, and the class's rows of ``I`` and ``i``.

        Classes of one id have no pieces.
        """
        kind = self.written[ids]
        order = np.argsort(kind, kind="stable")
        cuts = np.searchsorted(kind[order], np.arange(len(self.edges)))
        some = []
        for c in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(self.edges) > 1)):
            low, high = int(self.edges[c]), int(self.edges[c + 1])
            step = max(1, INNER // (high - low))
            some += [(at, min(at + step, int(cuts[c + 1])), low, high) for at in range(int(cuts[c]), int(cuts[c + 1]), step)]
        return order, some

    def gradients(self, x: np.ndarray, y: np.ndarray, used: np.ndarray) -> dict:
        """Of the mean loss of the ids ``y``, those of the last places of the windows ``x``, over the places ``used``.

        ``inner`` has those of ``I`` and ``i`` in pieces: first row, end, and the gradients of these rows.
        """
        p, scale, first, d = self.weights, np.float32(WIDTH**-0.5), WINDOW - y.shape[1], WIDTH
        rows = lambda t: t.reshape(-1, t.shape[2])
        times = lambda t, w: (rows(t) @ w).reshape(*t.shape[:2], w.shape[1])
        e = np.take(p["E"], x, axis=0)
        e += p["P"]
        last = np.ascontiguousarray(e[:, first:])
        both = np.hstack([p["K"], p["V"]])
        q, kv = times(last, p["Q"] * scale), times(e, both)
        k, v = kv[:, :, :d], kv[:, :, d:]
        s = _exp(q @ k.transpose(0, 2, 1), low=None)
        s *= np.tri(WINDOW, dtype=np.float32)[first:]
        s /= _sums(rows(s)).reshape(*s.shape[:2], 1)
        seen = s @ v
        z = rows(seen + last)
        place = np.flatnonzero(used)
        ids, share = y.ravel()[place], np.float32(1 / max(1, len(place)))
        order, some = self.inner(ids)
        place, ids = place[order], ids[order]
        own, kinds = z[place], self.written[ids].astype(np.int64)
        column = self.slot[ids] - self.edges[kinds]  # in the class
        out = own @ p["O"]
        out += p["o"]
        _exp(out)
        out *= (share / _sums(out))[:, None]
        out.reshape(-1)[np.arange(len(place)) * out.shape[1] + kinds] -= share
        down, inner = out @ p["O"].T, []
        for a, b, low, high in some:
            e2 = own[a:b] @ p["I"][low:high].T
            e2 += p["i"][low:high]
            _exp(e2)
            e2 *= (share / _sums(e2))[:, None]
            e2.reshape(-1)[np.arange(b - a) * (high - low) + column[a:b]] -= share
            down[a:b] += e2 @ p["I"][low:high]
            g = e2.T @ own[a:b], _sums(e2.T)
            if inner and inner[-1][0] == low:
                for total, more in zip(inner[-1][2:], g, strict=True):
                    total += more
            else:
                inner.append((low, high, *g))
        dz = np.zeros_like(seen)
        rows(dz)[place] = down
        ds, dkv = dz @ v.transpose(0, 2, 1), np.empty_like(kv)
        np.matmul(s.transpose(0, 2, 1), dz, out=dkv[:, :, d:])
        # The sum over the places seen of ds * s is that of dz * (s @ v).
        seen *= dz
        ds -= _sums(rows(seen)).reshape(*s.shape[:2], 1)
        ds *= s
        dq = ds @ k
        np.matmul(ds.transpose(0, 2, 1), q, out=dkv[:, :, :d])
        de = times(dkv, both.T)
        dlast = times(dq, p["Q"].T * scale)
        dlast += dz
        de[:, first:] += dlast
        at, dboth = x.ravel().astype(np.int64), rows(e).T @ rows(dkv)
        table = np.stack([np.bincount(at, c, len(p["E"])) for c in rows(de).T.astype(np.float64)], 1).astype(np.float32)
        return {
            "E": table, "P": de.sum(0), "Q": rows(last).T @ rows(dq) * scale, "K": dboth[:, :d], "V": dboth[:, d:],
            "O": own.T @ out, "o": _sums(out.T), "inner": inner,
        }

    def learn(self, count: int, take, least_steps: int, seed: int, rate: float = 0.01) -> None:
        """Over ``count`` windows, again and again up to ``least_steps``; ``take`` gathers those of one step.

        Adam, and for the rows of ``I`` and ``i``, of which a step has those of its classes, Adagrad.
        """
        random, per = np.random.default_rng(seed), -(-count // LEARN_BATCH)
        steps = max(per, least_steps)
        mean, square = ({n: np.zeros_like(w) for n, w in self.weights.items()} for _ in range(2))
        for t in range(steps):
            if t % per == 0:
                order = random.permutation(count)
            at = order[t % per * LEARN_BATCH : (t % per + 1) * LEARN_BATCH]
            now = rate * min(1.0, (t + 1) / 20) * (1 - 0.8 * t / steps)
            gradients = self.gradients(*take(at))
            for low, high, *both in _neighbours(gradients.pop("inner")):
                for name, g in zip("Ii", both, strict=True):
                    total = square[name][low:high]
                    total += g * g
                    root = np.sqrt(total)
                    root += np.float32(1e-6)
                    g *= np.float32(5 * now)
                    g /= root
                    self.weights[name][low:high] -= g
            for name, g in gradients.items():
                mean[name] += 0.1 * (g - mean[name])
                square[name] += 0.02 * (g * g - square[name])
                self.weights[name] -= np.float32(now) * (mean[name] / (1 - 0.9 ** (t + 1))) / (np.sqrt(square[name] / (1 - 0.98 ** (t + 1))) + 1e-8)

    def score(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Log-probabilities of the ids ``y`` at the last ``SCORED`` places of the windows ``x``."""
        p = self.weights
        first = WINDOW - SCORED
        scale = np.float32(WIDTH**-0.5)
        # Projections of all embeddings are made once; windows only gather them.
        tables = [(p["E"] @ w, p["P"] @ w) for w in (p["Q"] * scale, p["K"], p["V"])]
        (eq, pq), (ek, pk), (ev, pv) = tables
        visible = (~np.triu(np.ones((WINDOW, WINDOW), bool), 1)[first:]).astype(np.float32)
        out, hidden, written = np.empty(y.shape, np.float32), np.empty((*y.shape, WIDTH), np.float32), self.written[y]
        for at in range(0, len(x), BATCH):
            own = x[at : at + BATCH]
            last = own[:, first:]
            s = _exp((np.take(eq, last, axis=0) + pq[first:]) @ (np.take(ek, own, axis=0) + pk).transpose(0, 2, 1), low=None)
            s *= visible
            z = s @ (np.take(ev, own, axis=0) + pv)
            z /= _sums(s.reshape(-1, WINDOW)).reshape(*z.shape[:2], 1)
            z += np.take(p["E"], last, axis=0)
            z += p["P"][first:]
            hidden[at : at + BATCH] = z
            out[at : at + BATCH] = _picked(z.reshape(-1, WIDTH), p["O"], p["o"], written[at : at + BATCH].ravel()).reshape(-1, SCORED)
        flat, ids = out.reshape(-1), y.ravel()
        order, some = self.inner(ids)
        hidden, ids = np.take(hidden.reshape(-1, WIDTH), order, axis=0), ids[order]
        column, within = self.slot[ids] - self.edges[self.written[ids]], np.zeros(len(ids), np.float32)
        for a, b, low, high in some:
            within[a:b] = _picked(hidden[a:b], p["I"][low:high].T, p["i"][low:high], column[a:b])
        flat[order] += within
        return out


class Texts:
    """The ids of a block's texts, each with its end, in a row."""

    def __init__(self, row: dict) -> None:
        self.sizes = np.array(row["sizes"], np.int64)
        self.held = np.array(row["held"], bool)
        words, lengths = _unpack(row["text"], np.uint32), _unpack(row["lengths"], np.uint32).astype(np.int32)
        ids = _unpack(row["ids"], np.uint16)
        # The end is one more word of the block.
        starts = np.append(np.cumsum(lengths, dtype=np.int64) - lengths, len(ids))
        lengths, ids = np.append(lengths, np.int32(1)), np.append(ids, np.uint16(END))
        self.word = np.insert(words.astype(np.int32), np.cumsum(self.sizes), len(lengths) - 1)
        n = lengths[self.word]
        self.word_ends = np.cumsum(n, dtype=np.int64)
        self.ids = np.empty(self.word_ends[-1] if len(n) else 0, np.uint16)
        for a in range(0, len(n), PLACED):  # the ids' places are held for some words at a time
            some, own = self.word[a : a + PLACED], n[a : a + PLACED]
            ends = self.word_ends[a : a + PLACED]
            low = ends[0] - own[0]
            self.ids[low : ends[-1]] = ids[np.repeat(starts[some] - (ends - own), own) + np.arange(low, ends[-1])]
        self.last_words = np.cumsum(self.sizes + 1) - 1
        ends = self.word_ends[self.last_words] if len(n) else np.empty(0, np.int64)
        self.starts, self.ends = np.append(0, ends[:-1])[: len(ends)], ends

    def windows(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text and first scored place of every window of the texts ``docs``."""
        count = -(-(self.ends - self.starts)[docs] // SCORED)
        own = np.repeat(docs, count)
        return own, self.starts[own] + (np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)) * SCORED

    def coded(self, model: Model) -> None:
        """Number the ids by the model's classes, with room for windows that begin or end outside the texts."""
        room = np.zeros(WINDOW, np.int32)
        self.read = np.concatenate([room, model.read[self.ids], room])
        self.next = np.concatenate([self.ids, room.astype(np.uint16)])

    def inputs(self, own: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What the network reads at each place of the windows, the ids at the scored places, and which of these lie in the text."""
        x = self.read[(first + SCORED - 1)[:, None] + np.arange(WINDOW)]
        opens = np.flatnonzero(first == self.starts[own])  # only a text's first window reaches before it
        x[opens, : WINDOW - SCORED + 1] = START
        place = first[:, None] + np.arange(SCORED)
        return x, self.next[place], place < self.ends[own][:, None]


PARTS = ("sizes", "held", "text", "lengths", "ids")


def learned_block(texts: Texts, model: Model, number: int, rounds: int, train_every: int, least_steps: int) -> int:
    """Train ``model`` on the windows of a block's training texts that are round ``number``'s; how many these are."""
    own, first = texts.windows(np.flatnonzero(~texts.held))
    some = np.arange(number, len(own), train_every * rounds)
    if not len(some):
        return 0
    texts.coded(model)
    model.learn(len(some), lambda at: texts.inputs(own[some[at]], first[some[at]]), least_steps, seed=number)
    return len(some)


def train(stored_blocks: DataFrame, model: Model, rounds: int, train_every: int, least_steps: int) -> Model:
    """Weights after ``rounds`` of training in all tasks and averaging over them."""

    def averaged(batches):
        import pyarrow as pa

        total, weight = 0.0, 0
        for batch in batches:
            for w, n in zip(batch.column("weights").to_pylist(), batch.column("n").to_pylist(), strict=True):
                total, weight = total + n * np.frombuffer(w, np.float32).astype(np.float64), weight + n
        if weight:
            yield pa.RecordBatch.from_arrays([pa.array([(total / weight).astype(np.float32).tobytes()], pa.binary()), pa.array([weight], pa.int64())], names=["weights", "n"])

    for number in range(rounds):
        start = model.flat()

        def learned(batches, start=start, number=number):
            import pyarrow as pa

            total, windows = 0.0, 0
            for batch in batches:
                for at in range(batch.num_rows):
                    model.put(start)
                    if n := learned_block(Texts(batch.slice(at, 1).to_pylist()[0]), model, number, rounds, train_every, least_steps):
                        total, windows = total + n * model.flat().astype(np.float64), windows + n
            if windows:
                yield pa.RecordBatch.from_arrays([pa.array([(total / windows).astype(np.float32).tobytes()], pa.binary()), pa.array([windows], pa.int64())], names=["weights", "n"])

        schema = "weights binary, n long"
        local = mapped(stored_blocks.select(*PARTS), learned, schema)
        some = mapped(local.repartition(32), averaged, schema)
        done = mapped(some.repartition(1), averaged, schema).first()
        if done is not None:
            model.put(np.frombuffer(done["weights"], np.float32))
    return model


def lm_scores(
    docs: DataFrame,
    vocab: str,
    text: str = "text",
    doc_id: str = "doc_id",
    fold: int = 2,
    folds: int = 7,
    rounds: int = 2,
    train_every: int = 1,
    least_steps: int = 60,
    block_bytes: int = 12 << 20,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``vocab`` is a file of merge ranks, at the same path on every machine. Documents train unless the
    CRC-32 of their id leaves ``fold`` on division by ``folds``.
    """
    held = stored(blocks(docs, vocab, text, doc_id, fold, folds, block_bytes))
    counts = stored(word_counts(_words(held)))
    found = counts.where("first").agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    ids = _id_counts(held)
    ends = int(ids[END])
    tokens, kinds = int(found["n"] or 0) + ends, found["v"] + bool(ends)
    model = train(held, Model(ids), rounds, train_every, least_steps)
    back = counts.select("block", "i", "c").sortWithinPartitions("block")

    def gathered(batches):
        import pyarrow as pa

        for group in groups(batches, 1):
            packed = [_pack(group.column(c).to_numpy()) for c in ("i", "c")]
            yield pa.RecordBatch.from_arrays([pa.array([group.column("block")[0].as_py()], pa.int64()), *(pa.array([p], pa.binary()) for p in packed)], names=["block", "i", "c"])

    # Packed where they are read, then moved.
    known = mapped(back, gathered, "block long, i binary, c binary").groupBy("block").agg(F.collect_list(F.struct("i", "c")).alias("known"))

    def scored(batches):
        import pyarrow as pa

        names = [doc_id, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                texts = Texts(r)
                per_word = np.zeros(int(texts.word.max(initial=0)) + 1)
                for some in r["known"] or []:
                    per_word[_unpack(some["i"], np.int32)] = _unpack(some["c"], np.int64)
                per_word[texts.word[texts.last_words]] = ends
                logs = np.zeros(len(texts.ids), np.float32)
                own, first = texts.windows(np.arange(len(texts.sizes)))
                texts.coded(model)
                for a in range(0, len(own), 4096):
                    o, f = own[a : a + 4096], first[a : a + 4096]
                    x, y, inside = texts.inputs(o, f)
                    place = (f[:, None] + np.arange(SCORED))[inside]
                    logs[place] = model.score(x, y)[inside]
                word_starts = np.append(0, texts.word_ends[:-1])
                score = np.add.reduceat(logs, word_starts, dtype=np.float64) / np.log(10)
                base = np.log10((per_word + 1) / (tokens + kinds + 1))[texts.word]
                seen = (per_word > 0)[texts.word]
                doc_starts = np.append(0, texts.last_words[:-1] + 1)
                sums = [np.add.reduceat(v, doc_starts) for v in (base, score)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["docs"], pa.int64()), pa.array(texts.held), pa.array(texts.sizes + 1), pa.array(np.add.reduceat(seen, doc_starts, dtype=np.int64)),
                        pa.array(np.full(len(texts.sizes), tokens)), *(pa.array(s) for s in sums),
                    ],
                    names=names,
                )

    schema = f"`{doc_id}` long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return mapped(held.select("block", "docs", *PARTS).join(known, "block", "left"), scored, schema)
