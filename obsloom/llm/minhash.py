"""MinHash near-dedup with sequential Bayesian verification.

1. Every text becomes its set of five-word shingles, a signature of 128 minima and a digest of the
   whole set. Texts with equal sets are one class from here on, represented by its smallest id.
2. Signatures are cut into 32 bands of 4; classes that share a band meet in a bucket. Of the heads of its
   buckets, each class meets the one it shares most buckets with (a star, so n classes have at
   most n pairs). A second round with other heads follows, only across the components found so far.
3. Where classes meet, signatures are compared batch by batch. With m of n minima equal and an even prior, the
   similarity is Beta(m + 1, n - m + 1); a pair is dropped as soon as the chance that it reaches the
   threshold falls below ``miss``. Survivors are verified at once on the full sets, which are in the cell.
4. Buckets that still hold two or more components are compared across these, in cells of blocks of bounded
   size: the largest component's rows lie in one block each, those of the others are copied to the
   blocks. A cell joins components as it goes, so pairs of one component need no test, and gives
   back fewer links than it has components: links grow with a group's size, not its square. A pair is compared in its first
   common band only.
5. Components of the verified links give the result.

At the threshold a pair shares a band with probability 1 - (1 - 0.75**4)**32, 0.999995.

Defined results: null or empty text has no shingles and links with nothing. A row without an id gets
no component and is kept. Rows that repeat an id are one document: it has all their sets, and joins their classes.
"""

from __future__ import annotations

from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.llm.common import LOWER, SPACES, UPPER, groups, mapped, pieces, stored
from obsloom.llm.graph import components

WIDTH = 5
HASHES, ROWS, BATCH = 128, 4, 16
BLOCK = 512
_RANDOM = np.random.default_rng(20_240_601)
FACTORS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
SHIFTS = _RANDOM.integers(0, 1 << 63, HASHES, np.uint64)
PLACES = _RANDOM.integers(0, 1 << 63, WIDTH, np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES.encode())] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[list(UPPER.encode())] = list(LOWER.encode())


def word_hashes(texts) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of the lower-cased words of all texts in a row, and how many each text has.

    ``texts`` is a list, or an Arrow array without nulls. Bytes decide: A-Z and ASCII white space only.
    """
    import pyarrow as pa
    import xxhash

    if isinstance(texts, list):
        texts = pa.array([t.encode("utf-8", "surrogatepass") for t in texts], pa.binary())
    texts = texts.cast(pa.binary())
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    raw = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0] : ends[-1]] if ends[-1] > ends[0] else np.empty(0, np.uint8)
    ends = ends - ends[0]
    inside, apart = ~_SPACE[raw], np.zeros(len(raw) + 1, bool)
    apart[ends] = True
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1] | apart[1:-1]
    closes[:-1] &= ~inside[1:] | apart[1:-1]
    starts = np.flatnonzero(opens)
    counts = np.diff(np.searchsorted(starts, ends))
    if not len(starts):
        return np.empty(0, np.uint64), counts
    # Words and what is between them take turns in one Arrow array, over the bytes as they are.
    bounds = np.empty(2 * len(starts), np.int32)
    bounds[::2], bounds[1::2] = starts, np.flatnonzero(closes) + 1
    words = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(_LOWER[raw])]).dictionary_encode()
    known = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), np.uint64, len(words.dictionary))
    return known[words.indices.to_numpy()[::2]], counts


def shingle_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """The sorted, distinct shingle hashes of each text."""
    hashes, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    with np.errstate(over="ignore"):
        windows = max(0, len(hashes) - width + 1)
        rolled = np.zeros(windows, np.uint64)
        for i in range(width):
            rolled += hashes[i : i + windows] * PLACES[i]
        rolled = mixed(rolled)
        out = []
        for n, end in zip(counts, ends, strict=True):
            if n >= width:
                out.append(np.unique(rolled[end - n : end - width + 1]))
            elif n:
                short = (hashes[end - n : end] * PLACES[:n]).sum(dtype=np.uint64) + np.uint64(n)
                out.append(mixed(np.array([short])))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            x = shingles[at : at + 2048, None] * FACTORS
            x += SHIFTS
            np.minimum(least, x.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame, text: str, doc_id: str, width: int) -> DataFrame:
    """``(doc, n_shingles, digest, sig)`` for every row."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                sets = shingle_sets([t or "" for t in piece.column("text").to_pylist()], width)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                        pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["doc", "n_shingles", "digest", "sig"],
                )

    picked = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text"))
    return mapped(picked, run, "doc long, n_shingles long, digest binary, sig binary")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """``(id, digest, set)`` of the rows ``(id, text)`` that have shingles: the sorted hashes as bytes."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            for piece in pieces(batch, "text", 4 << 20):
                sets = [x.tobytes() for x in shingle_sets(piece.column("text").to_pylist(), width)]
                some = pa.array([len(x) > 0 for x in sets], pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()), pa.array(sets, pa.binary())], names=["id", "digest", "set"]
                ).filter(some)

    return mapped(texts.select("id", "text"), run, "id long, digest binary, set binary")


def least_matches(threshold: float, miss: float) -> np.ndarray:
    """For each number of batches compared, the fewest equal minima with which a pair stays."""
    least = []
    for n in range(BATCH, HASHES + 1, BATCH):
        # P(Beta(m + 1, n - m + 1) >= t) = P(Binomial(n + 1, t) <= m)
        below, m = 0.0, 0
        while m <= n:
            below += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if below >= miss:
                break
            m += 1
        least.append(m)
    return np.array(least)


def compared(left: np.ndarray, right: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Equal minima of each pair of signatures, -1 for pairs dropped on the way."""
    out = np.zeros(len(left), np.int64)
    live = np.arange(len(left))
    for i, need in enumerate(least):
        part = slice(i * BATCH, (i + 1) * BATCH)
        out[live] += (left[live, part] == right[live, part]).sum(axis=1)
        gone = out[live] < need
        out[live[gone]] = -1
        live = live[~gone]
    return out


def sig_array(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def set_array(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def overlaps(one: np.ndarray, many: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of a sorted set with each of several, none of them empty."""
    sizes = np.array([len(x) for x in many])
    flat = np.concatenate(many)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    return np.add.reduceat((one[at] == flat).astype(np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]))


def same_first_band(one: np.ndarray, many: np.ndarray, band: int) -> np.ndarray:
    """Whether ``band`` is the first one that a signature has in common with each of several."""
    equal = (many == one).reshape(len(many), HASHES // ROWS, ROWS).all(axis=2)
    return equal[:, band] & ~equal[:, :band].any(axis=1)


def cell_links(ids, comp, sig, sets, side, band: int, least: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between the components that meet in a cell: verified ones, and no more than components less one.

    ``side`` is 0, 1 or 2: rows of side 0 meet those of side 1 only, rows of side 2 meet each other. With a ``band`` that is not
    negative, a pair is left to the bucket of its first common band. A pair that earlier links of the cell have joined is not compared.
    """
    label = np.unique(comp, return_inverse=True)[1]
    order = np.argsort(side, kind="stable")
    ids, sig, side, label, sets = ids[order], sig[order], side[order], label[order], [sets[i] for i in order]
    size = np.array([len(x) for x in sets])
    out = []
    for at in range(len(ids) - 1):
        if side[at] == 1:
            break
        apart = label[at + 1 :] != label[at]
        if side[at] == 0:
            apart &= side[at + 1 :] == 1
        other = at + 1 + np.flatnonzero(apart)
        for start in range(0, len(other), 4096):
            some = other[start : start + 4096]
            some = some[label[some] != label[at]]
            if len(some) and band >= 0:
                some = some[same_first_band(sig[at], sig[some], band)]
            if len(some):
                some = some[compared(np.broadcast_to(sig[at], (len(some), HASHES)), sig[some], least) >= 0]
            if not len(some):
                continue
            both = overlaps(sets[at], [sets[i] for i in some])
            for i in some[100 * both >= percent * (size[at] + size[some] - both)]:
                if label[i] != label[at]:
                    label[label == label[i]] = label[at]
                    out.append((min(ids[at], ids[i]), max(ids[at], ids[i])))
    return out


def with_partners(ids, comp, sig, side, band: int, least: np.ndarray) -> np.ndarray:
    """Which rows of a cell have a likely partner, by signatures alone: the pairs that :func:`cell_links` would verify."""
    partner = np.zeros(len(ids), bool)
    for at in range(len(ids) - 1):
        rest = slice(at + 1, None)
        meets = (comp[rest] != comp[at]) & ((side[rest] == 2) if side[at] == 2 else (side[rest] == 1 - side[at]))
        some = at + 1 + np.flatnonzero(meets)
        for start in range(0, len(some), 4096):
            part = some[start : start + 4096]
            part = part[same_first_band(sig[at], sig[part], band)]
            part = part[compared(np.broadcast_to(sig[at], (len(part), HASHES)), sig[part], least) >= 0]
            partner[part] = True
            partner[at] |= len(part) > 0
    return partner


def likely_rows(cells: DataFrame, keys: list[str], percent: int, miss: float) -> DataFrame:
    """The rows of ``cells (*keys, band, side, id, comp, sig)`` that have a likely partner in their cell, without ``sig``."""
    least = least_matches(percent / 100, miss)
    columns = [*keys, "band", "side", "id", "comp"]
    placed = cells.select(*columns, "sig").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        import pyarrow as pa

        for group in groups(batches, len(keys)):
            ids, comp, side = (group.column(c).to_numpy() for c in ("id", "comp", "side"))
            partner = with_partners(ids, comp, sig_array(group.column("sig")), side, group.column("band")[0].as_py(), least)
            if partner.any():
                yield from group.select(columns).filter(pa.array(partner)).to_batches()

    return mapped(placed, run, placed.select(*columns).schema)


def linked(cells: DataFrame, keys: list[str], percent: int, miss: float) -> DataFrame:
    """``(a, b)``: what :func:`cell_links` finds in every cell of ``cells (*keys, band, side, id, comp, sig, set)``."""
    least = least_matches(percent / 100, miss)
    placed = cells.select(*keys, "band", "side", "id", "comp", "sig", "set").repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        import pyarrow as pa

        for group in groups(batches, len(keys)):
            ids, comp, side = (group.column(c).to_numpy() for c in ("id", "comp", "side"))
            found = cell_links(ids, comp, sig_array(group.column("sig")), set_array(group.column("set")), side, group.column("band")[0].as_py(), least, percent)
            if found:
                a, b = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return mapped(placed, run, "a long, b long").distinct()


def across(buckets: DataFrame, kinds: DataFrame, percent: int, miss: float, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: verified links of different components in ``buckets (bucket, band, id, comp)``; each has two or more.

    Signatures alone choose the rows of each cell that have anything to verify; only these get their sets (``kinds``: ``id, sig, set``).
    """
    sizes = buckets.groupBy("bucket", "comp").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("bucket").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.max("n").alias("most"), F.sum("n").alias("n"))
    rows = buckets.join(sizes, "bucket").withColumn("is_major", F.col("comp") == F.col("major"))
    wide, tall = F.ceil(F.col("most") / block).cast("int"), F.ceil((F.col("n") - F.col("most")) / block).cast("int")
    own = F.pmod(F.xxhash64("id"), F.when(F.col("is_major"), wide).otherwise(tall)).cast("int")
    # Cells (i, j): block i of the largest component against block j of the others. Cells (-1 - i, j), i <= j: blocks of the others.
    at = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.alias("side"))
    across_major = F.transform(F.sequence(F.lit(0), tall - 1), lambda j: at(own, j, F.lit(0)))
    from_minor = F.concat(
        F.transform(F.sequence(F.lit(0), wide - 1), lambda i: at(i, own, F.lit(1))),
        # Within a block all rows meet; of two blocks, the rows of one meet those of the other.
        F.transform(
            F.sequence(F.lit(0), tall - 1),
            lambda j: at(-1 - F.least(j, own), F.greatest(j, own), F.when(j == own, 2).when(own < j, 0).otherwise(1)),
        ),
    )
    cells = rows.select("bucket", "band", "id", "comp", F.explode(F.when(F.col("is_major"), across_major).otherwise(from_minor)).alias("cell"))
    cells = cells.select("bucket", "cell.i", "cell.j", "cell.side", "band", "id", "comp")
    keys = ["bucket", "i", "j"]
    cells = stored(likely_rows(cells.join(kinds.select("id", "sig"), "id"), keys, percent, miss))
    return linked(cells.join(kinds, "id"), keys, percent, miss)


def _stars(members: DataFrame, found: DataFrame | None, kinds: DataFrame, number: int, percent: int, miss: float, block: int = BLOCK) -> DataFrame:
    """Verified links ``(a, b)`` between each class and one head of its buckets in another component.

    A bucket's head is its smallest id in the first round, and another member by a hash in each later one. A head meets
    the classes that chose it in cells of bounded size; each class's set goes to one cell, the head's to all of its cells.
    """
    rows = members.select("bucket", "id")
    rows = rows.withColumn("comp", F.col("id")) if found is None else rows.join(found, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("comp"))
    order = F.xxhash64("id", F.lit(number)) if number else F.col("id")
    first = F.min(F.struct(order.alias("order"), "id", "comp")).alias("head")
    heads = rows.groupBy("bucket").agg(first, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi")
    pairs = rows.join(heads.select("bucket", F.col("head.id").alias("head"), F.col("head.comp").alias("head_comp")), "bucket").where("comp <> head_comp")
    shared = pairs.groupBy("id", "comp", "head", "head_comp").agg(F.count("*").alias("n"))
    chosen = shared.groupBy("id", "comp").agg(F.max_by(F.struct("head", "head_comp"), F.struct("n", -F.col("head"))).alias("to"))
    sizes = chosen.groupBy("to.head", "to.head_comp").agg(F.ceil(F.count("*") / block).cast("int").alias("slots"))
    chosen = chosen.select("id", "comp", "to.head").join(sizes.select("head", "slots"), "head")
    slot = F.pmod(F.xxhash64("id"), F.col("slots")).cast("int")
    rays = chosen.select("head", slot.alias("slot"), F.lit(1).alias("side"), "id", "comp")
    centres = sizes.select("head", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"), F.lit(0).alias("side"), F.col("head").alias("id"), F.col("head_comp").alias("comp"))
    cells = rays.unionByName(centres).join(kinds, "id").withColumn("band", F.lit(-1))
    return linked(cells, ["head", "slot"], percent, miss)


def near_duplicates(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", percent: int = 75, width: int = WIDTH, miss: float = 1e-6, rounds: int = 2
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links) and ``kept``.

    Documents link when their sets' similarity is at least ``percent``; ``miss`` is the chance to drop
    such a pair that the posterior bounds allow.
    """
    rows = stored(sketches(docs, text, doc_id, width))
    usable = rows.where("doc is not null and digest is not null")
    classes = usable.groupBy("digest").agg(F.min("doc").alias("id"))
    # One row per class: the class is its smallest id.
    kinds = stored(classes.join(usable.select("digest", "sig", F.col("doc").alias("id")), ["digest", "id"]).dropDuplicates(["digest", "id"]))
    bands = F.transform(F.sequence(F.lit(0), F.lit(HASHES // ROWS - 1)), lambda i: F.xxhash64(F.substring("sig", i * ROWS * 4 + 1, F.lit(ROWS * 4)), i))
    members = kinds.select("id", F.posexplode(bands).alias("band", "bucket"))
    heads = members.groupBy("bucket").agg(F.min("id").alias("head"), F.max("id").alias("last")).where("head <> last").select("bucket", "head")
    members = stored(members.join(heads, "bucket").select("bucket", "band", "id").distinct())
    # The full sets of classes that share a band, once each.
    wanted = members.select("id").distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).where(F.col(text).isNotNull()).join(wanted, "id")
    kinds = stored(full_sets(texts, width).join(kinds, ["digest", "id"]).dropDuplicates(["digest", "id"]).select("id", "sig", "set"))
    # A document of several rows and sets joins their classes.
    several = usable.groupBy("doc").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("doc")
    links = usable.join(several, "doc").join(classes, "digest").select(F.col("doc").alias("a"), F.col("id").alias("b")).where("a <> b").distinct()
    found = None
    for number in range(rounds):
        more = stored(_stars(members, found, kinds, number, percent, miss))
        if number and more.isEmpty():
            break
        found = components((links if found is None else as_links(found)).unionByName(more))
    comps = members.join(found, "id", "left").select("bucket", "band", "id", F.coalesce("component", "id").alias("comp"))
    mixed_buckets = comps.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("bucket")
    more = stored(across(stored(comps.join(mixed_buckets, "bucket")), kinds, percent, miss))
    found = components(as_links(found).unionByName(more))
    per_class = classes.join(found, "id", "left").select("digest", F.coalesce("component", "id").alias("component"))
    return rows.join(per_class, "digest", "left").select(
        F.col("doc").alias(doc_id),
        "n_shingles",
        F.when(F.col("doc").isNotNull(), F.coalesce("component", "doc")).alias("component_id"),
        F.coalesce(F.coalesce("component", "doc") == F.col("doc"), F.lit(True)).alias("kept"),
    )


def as_links(found: DataFrame) -> DataFrame:
    return found.select(F.col("id").alias("a"), F.col("component").alias("b"))
