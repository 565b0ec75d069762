"""Hard negatives by a threshold join in the manner of L2AP, in whole numbers.

Vectors become integers, ``floor(scale * x)``, so that scores (inner products) are exact. An anchor's
positives are its best rows of the same label; its hard negatives are, for every positive, the best
rows of other labels whose score lies in a window relative to the positive's.

Both are searches for the best ``keep`` rows in a window of scores. Anchors and rows are cut into blocks
by a hash, and every block of anchors meets every block of rows in one task. There, dimensions go from
the heaviest to the lightest. Beyond some dimension the norm of what is left of a row, times the largest
such norm of the anchors, is below the lowest threshold: these dimensions are not in the row's postings. Partial
scores are accumulated over the postings, a few dimensions at a time; a row goes as soon as its partial score with
every anchor, plus the product of the remaining norms, is below the anchor's threshold. What survives
is completed from the dimensions that were left out.

A window's threshold starts high, at the best score that a bounded sample of the rows has there, and is
lowered, to the sample's ``keep``-th score and then to the window's end, until ``keep`` rows are found:
all rows at or above a threshold are found, so a full window is final. The sample (at most about
``sample`` rows) sets thresholds only; results are exact without regard to it.

Defined results: rows without an id or label, with a null vector, or with null or non-finite
components take no part. Rows equal in id, label and vector are one row; rows that repeat an id otherwise
are rows of their own. A shorter vector counts as one with zeros behind. A component beyond
+-sqrt(2^53 / size) counts as that bound, so that doubles hold every score exactly. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsloom.llm.common import groups, mapped, stored

#: Dimensions of the postings that are accumulated before rows are pruned, and anchors that search together.
CHUNK, STEP = 8, 64
BLOCK = 16384
LOWEST, HIGHEST = -(1 << 60), 1 << 60


class Postings:
    """A block of rows by dimension, for anchors of a block and a lowest threshold."""

    def __init__(self, rows: np.ndarray, anchors: np.ndarray, lowest: float) -> None:
        self.dims = np.argsort(-(anchors * anchors).sum(axis=0), kind="stable")
        rows = rows[:, self.dims]
        left = suffix_norms(rows)
        most = suffix_norms(anchors[:, self.dims]).max(axis=0)
        # How many dimensions a row is posted under: the rest cannot reach the threshold alone.
        posted = (left * most + 0.5 >= lowest).sum(axis=1) if lowest > 0 else np.full(len(rows), rows.shape[1])
        posted = np.minimum(posted, rows.shape[1])
        # In this order every dimension's postings are the first so many rows.
        self.order = np.argsort(-posted, kind="stable")
        self.rows, self.left, self.posted = rows[self.order], left[self.order], posted[self.order]
        self.lengths = (self.posted[:, None] > np.arange(rows.shape[1])).sum(axis=0)

    def search(self, anchors: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs (anchor, row, score) at or above the anchors' thresholds, and every such pair."""
        anchors = anchors[:, self.dims]
        rest = suffix_norms(anchors)
        size = anchors.shape[1]
        at = np.arange(int(self.lengths[0]) if size else 0)
        partial = np.zeros((len(anchors), len(at)))
        for c in range(0, size, CHUNK):
            # The surviving rows are in the order of the postings, so those of this dimension come first.
            n = int(np.searchsorted(at, self.lengths[c]))
            if not n:
                break
            partial[:, :n] += anchors[:, c : c + CHUNK] @ self.rows[at[:n], c : c + CHUNK].T
            done = np.minimum(c + CHUNK, size)
            # A row that is not posted any further has all that it was not posted under ahead of it.
            ahead = np.full(len(at), done)
            ahead[n:] = self.reached(at[n:])
            alive = (partial + rest[:, ahead] * self.left[at, ahead] + 0.5 >= low[:, None]).any(axis=0)
            if alive.sum() < 0.75 * len(at):
                at, partial = at[alive], partial[:, alive]
        reached = self.reached(at)
        a, r = np.nonzero(partial + rest[:, reached] * self.left[at, reached] + 0.5 >= low[:, None])
        score, row = partial[a, r], at[r]
        for end in np.unique(reached[r]):
            if end < size:
                some = np.flatnonzero(reached[r] == end)
                for b in range(0, len(some), 1 << 16):
                    s = some[b : b + (1 << 16)]
                    score[s] += (anchors[a[s], end:] * self.rows[row[s], end:]).sum(axis=1)
        good = score >= low[a]
        return a[good], self.order[row[good]], score[good].astype(np.int64)

    def reached(self, at: np.ndarray) -> np.ndarray:
        """Up to where the partial scores of rows go: the end of the last chunk in which they are posted."""
        return np.minimum(-(-self.posted[at] // CHUNK) * CHUNK, self.rows.shape[1])


def suffix_norms(rows: np.ndarray) -> np.ndarray:
    """Upper bounds of the norms of what follows each dimension, itself included; 0 behind the last."""
    squares = np.cumsum((rows * rows)[:, ::-1], axis=1)[:, ::-1]
    return np.hstack([np.sqrt(squares) * (1 + 1e-12), np.zeros((len(rows), 1))])


def padded(column, size: int) -> np.ndarray:
    """A list column as rows of a matrix, with zeros behind shorter lists."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), size))
    out[np.arange(size) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def cell(group, size: int, keep: int, same: bool):
    """The best ``keep`` rows of this block for every window of every anchor of the block, as columns."""
    side = group.column("side").to_numpy()
    anchors, rows = (group.filter(side == s).combine_chunks() for s in (0, 1))
    if not anchors.num_rows or not rows.num_rows:
        return None
    q, y = (padded(t.column("v").combine_chunks(), size) for t in (anchors, rows))
    labels = np.unique(np.concatenate([np.array(t.column("label").to_pylist()) for t in (anchors, rows)]), return_inverse=True)[1]
    q_label, y_label = labels[: len(q)], labels[len(q) :]
    (q_id, q_row), (y_id, y_row) = ((t.column("id").to_numpy(), t.column("row").to_numpy()) for t in (anchors, rows))
    windows = anchors.column("windows").to_pylist()
    low = np.array([min(w["low"] for w in x) for x in windows], np.float64)
    index = Postings(y, q, low.min())
    out = []
    for start in range(0, len(q), STEP):
        mine = slice(start, start + STEP)
        a, r, score = index.search(q[mine], low[mine])
        a = a + start
        wanted = (q_label[a] == y_label[r]) == same
        if same:
            wanted &= (q_id[a] != y_id[r]) | (q_row[a] != y_row[r])
        a, r, score = a[wanted], r[wanted], score[wanted]
        order = np.lexsort((y_row[r], y_id[r], -score, a))
        a, r, score = a[order], r[order], score[order]
        of = windows[mine]
        for k in range(max((len(x) for x in of), default=0)):
            number = np.array([x[k]["w"] if k < len(x) else -1 for x in of])
            floor = np.array([x[k]["low"] if k < len(x) else HIGHEST for x in of])
            top = np.array([x[k]["high"] if k < len(x) else LOWEST for x in of])
            inside = np.flatnonzero((score >= floor[a - start]) & (score <= top[a - start]))
            if len(inside):
                b = a[inside]
                rank = np.arange(len(b)) - np.searchsorted(b, b)
                inside = inside[rank < keep]
                out.append((q_row[a[inside]], number[a[inside] - start], y_id[r[inside]], y_row[r[inside]], score[inside]))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else None


FOUND = "a long, w int, other long, other_row long, score long"


def in_windows(rows: DataFrame, anchors: DataFrame, windows: DataFrame, keep: int, same: bool, size: int, row_blocks: int, anchor_blocks: int) -> DataFrame:
    """The best ``keep`` rows between ``low`` and ``high`` of every window (``a``, ``w``), by blocks: columns ``FOUND``."""
    asked = windows.groupBy(F.col("a").alias("row")).agg(F.collect_list(F.struct("w", "low", "high")).alias("windows"))
    left = anchors.join(asked, "row").select(
        F.pmod(F.xxhash64("row"), F.lit(anchor_blocks)).cast("int").alias("i"),
        F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("j"),
        F.lit(0).alias("side"), "id", "row", "label", "v", "windows",
    )
    right = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))).alias("i"),
        F.pmod(F.xxhash64("row"), F.lit(row_blocks)).cast("int").alias("j"),
        F.lit(1).alias("side"), "id", "row", "label", "v", F.lit(None).cast(left.schema["windows"].dataType).alias("windows"),
    )
    met = left.unionByName(right).repartition(row_blocks * anchor_blocks, "i", "j").sortWithinPartitions("i", "j")

    def run(batches):
        import pyarrow as pa

        for group in groups(batches, 2):
            columns = cell(group, size, keep, same)
            if columns is not None:
                a, w, other, other_row, score = columns
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a), pa.array(w.astype(np.int32)), pa.array(other), pa.array(other_row), pa.array(score)],
                    names=["a", "w", "other", "other_row", "score"],
                )

    best = Window.partitionBy("a", "w").orderBy(F.desc("score"), "other", "other_row")
    return mapped(met, run, FOUND).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= keep)


def best_rows(rows: DataFrame, anchors: DataFrame, windows: DataFrame, keep: int, same: bool, size: int, sample_of: int, row_blocks: int, anchor_blocks: int) -> DataFrame:
    """The best ``keep`` rows of every window, with thresholds that are lowered until it is full: ``FOUND`` with ``rank``."""
    few = rows.where(F.pmod(F.xxhash64("row", F.lit("sample")), F.lit(sample_of)) == 0)
    seen = in_windows(few, anchors, windows, keep, same, size, 1, anchor_blocks).groupBy("a", "w").agg(
        F.max("score").alias("best"), F.when(F.count("*") == keep, F.min("score")).alias("last")
    )
    windows = stored(windows.join(seen, ["a", "w"], "left"))
    done = None
    # In each round, the threshold of a window: the sample's best score, the last of its best, or the window's own end.
    for threshold in (F.coalesce("best", "last", "low"), F.coalesce("last", "low"), F.col("low")):
        asked = windows.select("a", "w", threshold.alias("low"), "high", F.col("low").alias("end"))
        found = stored(in_windows(rows, anchors, asked.drop("end"), keep, same, size, row_blocks, anchor_blocks))
        counts = found.groupBy("a", "w").agg(F.count("*").alias("n"))
        # Full, or searched down to its end.
        state = asked.join(counts, ["a", "w"], "left").select("a", "w", ((F.coalesce("n", F.lit(0)) >= keep) | (F.col("low") <= F.col("end"))).alias("final"))
        state = stored(state)
        final = found.join(state.where("final"), ["a", "w"], "left_semi")
        done = final if done is None else done.unionByName(final)
        windows = stored(windows.join(state.where("not final"), ["a", "w"], "left_semi"))
        if windows.isEmpty():
            break
    return done


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
    scale: int = 256,
    sample: int = 4096,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id`` and both scores, for the rows where ``anchor`` holds.

    A negative's score is at least ``low_percent`` and at most ``high_percent`` hundredths of the positive's.
    """
    spark = vectors.sparkSession
    v = F.col(embedding).cast("array<double>")
    usable = F.col(vec_id).isNotNull() & F.col(label).isNotNull() & v.isNotNull()
    usable = usable & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    size = max(vectors.agg(F.max(F.size(embedding))).first()[0] or 1, 1)
    largest = float(math.isqrt((1 << 53) // size))
    whole = F.transform(v, lambda x: F.floor(F.greatest(F.lit(-largest), F.least(F.lit(largest), x * scale))).cast("int"))
    rows = vectors.where(usable).select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), whole.alias("v"), F.coalesce(anchor, F.lit(False)).alias("anchor")
    )
    rows = rows.withColumn("row", F.xxhash64("id", "label", "v"))
    rows = stored(rows.groupBy("id", "row").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.max("anchor").alias("anchor")))
    n = rows.count()
    anchors = rows.where("anchor").select("id", "row", "label", "v")
    # Blocks of bounded size, and enough of them for all cores.
    blocks = {
        "size": size,
        "sample_of": max(1, math.ceil(n / sample)),
        "row_blocks": max(math.ceil(n / block), min(spark.sparkContext.defaultParallelism, math.ceil(n / 1024)), 1),
        "anchor_blocks": max(1, math.ceil(anchors.count() / block)),
    }
    anywhere = anchors.select(F.col("row").alias("a"), F.lit(0).alias("w"), F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"))
    near = best_rows(rows, anchors, anywhere, positives, True, **blocks)
    near = stored(near.select("a", F.col("rank").cast("int").alias("w"), F.col("other").alias("positive_id"), F.col("score").alias("positive_score")))
    score = F.col("positive_score")
    # Whole numbers between low and high hundredths of the score; none if the score is negative.
    bounds = near.where(score >= 0).select(
        "a", "w", F.expr(f"({low_percent} * positive_score + 99) div 100").alias("low"), F.expr(f"({high_percent} * positive_score) div 100").alias("high")
    )
    found = best_rows(rows, anchors, bounds.where("low <= high"), negatives, False, **blocks)
    names = anchors.select(F.col("row").alias("a"), F.col("id").alias("anchor_id"))
    return found.join(near, ["a", "w"]).join(names, "a").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
