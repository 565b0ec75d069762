"""Embedding near-dedup by Euclidean p-stable hashing.

Vectors are scaled to length 1, where a cosine is a distance. A table's hash is the cell of ``bits``
random projections, each shifted and cut into steps of ``step``; vectors of one label that share a
cell in any of ``tables`` tables are compared by their exact cosine in double precision. At a
distance d a projection agrees with probability 1 - 2 N(-w/d) - 2 d / (w sqrt(2 pi)) (1 - exp(-w^2 / 2 d^2)).

``bits`` grows with the logarithm of the counted vectors of the largest label, so that a cell holds about
``meet`` of them by chance (at cosine 0) however many there are, and ``tables`` follows from the asked ``miss``
of a pair at the threshold; closer pairs are missed far less. At 0.93, 1,000 vectors take 4 bits and 13 tables,
a million 13 and 71: the tables grow with about the 0.22th power of the rows, the comparisons of a vector alike.
A cell of 128 costs one small product, hardly more than a cell of 8, and takes half the tables.

Equal vectors of a label are one class first, so copies are never compared with each other. Cells with many
classes are cut into blocks that are compared in pairs, by tasks of bounded size. A pair is counted in the first
table in which it meets, so links need not be collected to count them once; tasks give, per vector,
its number of links and the smallest vector it is joined with.

Defined results: a null or empty vector, one of zeros or with null or non-finite components, and one
without a label link with nothing; vectors of different lengths do not link. A row without an id takes
no part and is kept, with a null component. Rows that repeat an id count as vectors of their own.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.llm.common import mapped, runs, stored
from obsloom.llm.graph import components

BLOCK = 1024


class Hashes:
    """Random projections for vectors of one length, the same on every machine."""

    def __init__(self, size: int, tables: int, bits: int, step: float) -> None:
        random = np.random.default_rng([size, tables, bits, 7])
        self.lines = random.standard_normal((size, tables * bits))
        self.shift = random.uniform(0, step, tables * bits)
        self.mix = random.integers(0, 1 << 62, (tables, bits), np.int64) * 2 + 1
        self.tables, self.bits, self.step = tables, bits, step

    def cells(self, units: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each vector's cell, by table."""
        steps = np.floor((units @ self.lines + self.shift) / self.step).astype(np.int64).reshape(len(units), self.tables, self.bits)
        with np.errstate(over="ignore"):
            return (steps * self.mix).sum(axis=2)


def agreement(cosine: float, step: float) -> float:
    """How likely one projection puts two unit vectors of this cosine into one step."""
    d = math.sqrt(max(2 - 2 * cosine, 0.0))
    if not d:
        return 1.0
    tail = math.erfc(step / d / math.sqrt(2)) / 2
    return 1 - 2 * tail - 2 * d / (step * math.sqrt(2 * math.pi)) * (1 - math.exp(-(step * step) / (2 * d * d)))


def plan(rows: int, threshold: float, miss: float, step: float, meet: int) -> tuple[int, int]:
    """Bits and tables for ``rows`` vectors of one label."""
    bits = max(math.ceil(math.log(max(rows / meet, 1.0)) / -math.log(agreement(0.0, step))), 4)
    found = agreement(threshold, step) ** bits
    return bits, math.ceil(math.log(miss) / math.log1p(-found)) if found < 1 else 1


def lengths_of(column) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.list_value_length(column).to_numpy(zero_copy_only=False)


def unit_rows(column) -> np.ndarray:
    import pyarrow as pa

    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    vectors = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    with np.errstate(over="ignore"):
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # the square of a very large component would overflow
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` is joined with by the links ``a``-``b``."""
    low = np.arange(n)
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def cell_links(units: np.ndarray, at: np.ndarray, rows: dict, hashes: Hashes, threshold: float):
    """Kind, id, links counted here and smallest id joined with, for the vectors of a cell that have links; or None.

    The cell's vectors are ``units``, in ``rows`` at the places ``at``. Most cells have no links, and cost one product.
    """
    i, j = rows["i"][at[0]], rows["j"][at[0]]
    left = right = slice(None)
    if i != j:
        own = rows["own"][at]
        left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
    p, q = np.nonzero(units[left] @ units[right].T >= threshold)
    if i == j:
        p, q = p[p < q], q[p < q]
    else:
        p, q = left[p], right[q]
    if not len(p):
        return None
    # A pair belongs to the first table in which it meets; most near ones leave within a few tables.
    some = np.unique(np.concatenate([p, q]))
    cells, p, q = hashes.cells(units[some]), np.searchsorted(some, p), np.searchsorted(some, q)
    for table in range(rows["tab"][at[0]]):
        fresh = cells[p, table] != cells[q, table]
        p, q = p[fresh], q[fresh]
        if not len(p):
            return None
    here = np.unique(np.concatenate([p, q]))
    some, p, q = some[here], np.searchsorted(here, p), np.searchsorted(here, q)
    ids, n = rows["id"][at[some]], rows["n"][at[some]]
    links = np.bincount(p, n[q], len(some)) + np.bincount(q, n[p], len(some))
    order = np.argsort(ids, kind="stable")
    rank = np.argsort(order)
    low = ids[order][roots(len(some), rank[p], rank[q])[rank]]
    return rows["kind"][at[some]], ids, links.astype(np.int64), low


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = 0.93,
    miss: float = 1e-4,
    step: float = 2.0,
    meet: int = 128,
    block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors``: ``vec_id``, ``n_links``, ``component_id`` and ``kept``.

    ``miss`` is the chance that a pair at the threshold is not found; ``meet`` is about how many vectors
    without anything in common share a cell of the largest label.
    """
    cast = F.col(embedding).cast("array<double>")
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
    usable = usable & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("string").alias("label"), cast.alias("v"))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # A class goes by the 128-bit hash of its vector and label.
    rows = rows.withColumn("k", F.when(F.col("usable"), F.struct(F.xxhash64("label", "v").alias("h1"), F.xxhash64(F.lit("v"), "label", "v").alias("h2"))))
    sizes = rows.where("usable").groupBy("k").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    kinds = rows.where("usable").select("k", "id", "label", "v").join(sizes, ["k", "id"]).dropDuplicates(["k", "id"])
    # Rows that repeat an id may head several classes, so a class has a number of its own.
    kinds = stored(kinds.select(F.xxhash64("k").alias("kind"), "k", "id", "n", "label", "v"))
    largest = kinds.groupBy("label").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits, tables = plan(largest, threshold, miss, step, meet)

    def hashed(batches):
        import pyarrow as pa

        made: dict[int, Hashes] = {}
        for batch in batches:
            lengths = lengths_of(batch.column("v"))
            for size in np.unique(lengths):
                some = batch.filter(pa.array(lengths == size))
                hashes = made.setdefault(int(size), Hashes(int(size), tables, bits, step))
                cells = hashes.cells(unit_rows(some.column("v")))
                kind = np.repeat(some.column("kind").to_numpy(), tables)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.array(np.tile(np.arange(tables, dtype=np.int32), len(cells))), pa.array(cells.ravel())],
                    names=["kind", "tab", "cell"],
                )

    cells = mapped(kinds.select("kind", "v"), hashed, "kind long, tab int, cell long").join(kinds.select("kind", "label", F.size("v").alias("size")), "kind")
    cells = cells.select("kind", "tab", F.xxhash64("tab", "cell", "label", "size").alias("bucket"))
    full = cells.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1")
    placed = stored(cells.join(full, "bucket").select("bucket", "tab", "kind", F.ceil(F.col("members") / block).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("kind"), F.col("blocks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least(j, own).alias("i"), F.greatest(j, own).alias("j")))
    spread = placed.select("bucket", "tab", "kind", own.alias("own"), F.explode(pairs).alias("at"))
    spread = spread.join(kinds.select("kind", "id", "n", "label", "v"), "kind")
    spread = spread.select("bucket", "at.i", "at.j", "tab", "own", "kind", "id", "n", "label", "v")
    spread = spread.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def linked(batches):
        import pyarrow as pa

        made: dict[int, Hashes] = {}
        names = ("kind", "own", "id", "n", "i", "j", "tab")
        for table, cuts in runs(batches, 3):
            # Cells are small and many: columns are unpacked once for all of them.
            columns = {c: table.column(c).to_numpy() for c in names}
            lists, lengths = table.column("v"), lengths_of(table.column("v"))
            labels = table.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
            sort = labels * (int(lengths.max()) + 1) + lengths
            alike = np.minimum.reduceat(sort, cuts[:-1]) == np.maximum.reduceat(sort, cuts[:-1])
            units = {int(size): unit_rows(lists.filter(pa.array(lengths == size))) for size in np.unique(lengths)}
            place = np.zeros(len(lengths), np.int64)  # of a row among those of its length
            for size in units:
                place[lengths == size] = np.arange((lengths == size).sum())
            out = []
            for start, end, same in zip(cuts[:-1], cuts[1:], alike, strict=True):
                rows_ = np.arange(start, end)
                # Buckets whose 64-bit hashes are equal by chance hold several labels or lengths.
                for at in [rows_] if same else [rows_[sort[start:end] == x] for x in np.unique(sort[start:end])]:
                    if len(at) > 1:
                        size = int(lengths[at[0]])
                        hashes = made.setdefault(size, Hashes(size, tables, bits, step))
                        first = place[at[0]]
                        of_cell = units[size][first : first + len(at)] if same else units[size][place[at]]
                        linked_ = cell_links(of_cell, at, columns, hashes, threshold)
                        if linked_ is not None:
                            out.append(linked_)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["kind", "id", "links", "low"])

    found = stored(mapped(spread, linked, "kind long, id long, links long, low long"))
    joined = components(found.select(F.col("id").alias("a"), F.col("low").alias("b")))
    counts = found.groupBy("kind").agg(F.sum("links").alias("links"))
    per_kind = kinds.select("kind", "k", "id", "n").join(counts, "kind", "left").join(joined, "id", "left")
    per_kind = per_kind.select(
        F.col("k").alias("__k"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "id").alias("component")
    )
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return rows.join(per_kind, F.col("k") == F.col("__k"), "left").select(
        F.col("id").alias(vec_id),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )
