"""Line dedup by levelled sorted runs of line hashes.

A run holds ``(h1, h2, docs, owner)``: the 128-bit hash of a line key, in how many documents it was
found, and the largest document id among them. Batches of documents come in descending order of
their ids. Each batch is merge-anti-joined with the runs of *settled* keys, those already found in
enough documents: their owner is in some run, as no later batch has a larger id, so nothing more
needs to be counted. What is left is counted and added as a run of level 0. When a level has
``fanout`` runs they are compacted into one run of the next level, and keys that reach the threshold
settle. Frequent lines therefore leave the stream early, and are never gathered in one task. The last
merge takes the largest id over all runs.

Defined results: null or empty text is one empty line. Rows without an id lose nothing. Rows that
repeat an id are one document when documents are counted. Columns of the input named as a column of
the result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.llm.common import ascii_lower, stored, stripped

HASH = ["h1", "h2"]
RUN = [*HASH, "docs", "owner"]


def line_key(line: Column) -> Column:
    """The line without surrounding white space and with A-Z in lower case."""
    return ascii_lower(stripped(line))


class LineRuns:
    """Levelled runs in the shared folder; ``settled`` keys have reached the threshold."""

    def __init__(self, min_docs: int, fanout: int = 2) -> None:
        self.min_docs = min_docs
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def add(self, lines: DataFrame) -> None:
        """Add the lines ``(h1, h2, doc)`` of a batch whose ids are below those of all batches before."""
        for run in self.settled:
            lines = lines.join(run.select(*HASH).hint("merge"), HASH, "left_anti")
        own = lines.select(*HASH, "doc").distinct().groupBy(*HASH).agg(F.count("*").alias("docs"), F.max("doc").alias("owner"))
        self._put(0, stored(own.sortWithinPartitions(*HASH)))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            self._compact(level)
            level += 1

    def close(self) -> DataFrame:
        """Merge all runs; ``(h1, h2, owner)`` of the keys that reached the threshold."""
        merged = None
        for run in [*self.settled, *(run for level in self.levels for run in level)]:
            merged = run if merged is None else merged.unionByName(run)
        merged = merged.groupBy(*HASH).agg(F.sum("docs").alias("docs"), F.max("owner").alias("owner"))
        return stored(merged.where(F.col("docs") >= self.min_docs).select(*HASH, "owner").sortWithinPartitions(*HASH))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)

    def _compact(self, level: int) -> None:
        merged = None
        for run in self.levels[level]:
            merged = run if merged is None else merged.unionByName(run)
        merged = merged.groupBy(*HASH).agg(F.sum("docs").alias("docs"), F.max("owner").alias("owner"))
        merged = stored(merged.withColumn("done", F.col("docs") >= self.min_docs).sortWithinPartitions(*HASH), "done")
        self.levels[level] = []
        self.settled.append(merged.where("done").select(*RUN))
        self._put(level + 1, merged.where("not done").select(*RUN))


def dedup_lines(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    min_chars: int = 40,
    min_docs: int = 5,
    batches: int = 4,
    fanout: int = 2,
) -> DataFrame:
    """``docs`` with the lines left in ``text``, and ``n_lines`` and ``n_dropped``.

    Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all
    their lines, except in the document with the largest id. Documents are dealt into ``batches``
    of about equal size by their ids.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    cuts = docs.agg(F.percentile_approx(doc_id, [i / batches for i in range(1, batches)], 10000)).first()[0] if batches > 1 else []
    number = F.lit(0)
    for cut in sorted(set(cuts or [])):
        number = number + (F.col("doc") <= F.lit(cut)).cast("int")
    lines = (
        docs.where(F.col(doc_id).isNotNull())
        .select(F.col(doc_id).alias("doc"), F.xxhash64(body).alias("row"), F.posexplode(F.split(body, "\n", -1)).alias("pos", "line"))
        .withColumn("line", line_key(F.col("line")))
        .where(F.length("line") >= min_chars)
        .select("doc", "row", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"), number.alias("batch"))
    )
    lines = stored(lines, "batch")
    runs = LineRuns(min_docs, fanout)
    for batch in range(len(set(cuts or [])) + 1):
        runs.add(lines.where(F.col("batch") == batch).select("doc", *HASH))
    drops = (
        lines.join(runs.close(), HASH)
        .where(F.col("doc") != F.col("owner"))
        .groupBy("doc", "row")
        .agg(F.sort_array(F.collect_set("pos")).alias("drops"))
    )
    all_lines = F.split(body, "\n", -1)
    left = docs.select("*", F.struct(F.col(doc_id).alias("doc"), F.xxhash64(body).alias("row")).alias("__at"))
    joined = left.join(drops.select(F.struct("doc", "row").alias("__of"), F.col("drops").alias("__drops")), F.col("__at") == F.col("__of"), "left")
    ends = F.concat("__drops", F.array(F.size(all_lines)))

    def kept(end: Column, i: Column) -> Column:
        start = F.coalesce(F.get("__drops", i - 1) + 1, F.lit(0))
        return F.slice(all_lines, start + 1, end - start)

    return joined.withColumns(
        {
            text: F.when(F.col("__drops").isNull(), body).otherwise(F.array_join(F.flatten(F.transform(ends, kept)), "\n")),
            "n_lines": F.size(all_lines).cast("long"),
            "n_dropped": F.coalesce(F.size("__drops"), F.lit(0)).cast("long"),
        }
    ).drop("__at", "__of", "__drops")
