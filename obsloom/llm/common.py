"""What the operators share: white space, lower case, row keys and tables in the shared folder."""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsloom.registered.common import scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: The white space that separates words, and nothing else does.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are. ``lower`` is quicker, and right where all is ASCII."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


#: Spark removes the shuffle files of a query when it has ended.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, *partition_by: str, folder: str | None = None, release: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it from there: lineage ends, and a lost executor loses nothing.

    With ``release`` the shuffle files of the write are removed when it has ended; otherwise they stay until the driver collects garbage.
    """
    path = folder or scratch(df.sparkSession)
    conf = df.sparkSession.conf
    before = conf.get(RELEASE, "false")
    if release:
        conf.set(RELEASE, "true")
    try:
        writer = df.write.mode("error")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    finally:
        if release:
            conf.set(RELEASE, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unit(value: Column) -> Column:
    """A number in [0, 1) from the md5 of a text: the same for equal texts on every run and engine."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def with_columns(docs: DataFrame, text: str, fields: str, maker, *args, piece_bytes: int = 4 << 20) -> DataFrame:
    """``docs`` with new columns made in Python from the texts.

    ``maker(*args)`` runs in each task and gives a function from a list of texts to a list of Arrow
    arrays, one for each of ``fields`` (DDL). It gets whole texts, of about ``piece_bytes`` together;
    null comes as an empty text. Columns of ``docs`` with a new column's name are replaced.
    """
    import pyarrow as pa

    new = StructType.fromDDL(fields)
    names = {f.name for f in new}
    schema = StructType([f for f in docs.schema if f.name not in names] + new.fields)
    old = [f.name for f in docs.schema if f.name not in names]

    def run(batches):
        make = maker(*args)
        for batch in batches:
            for piece in pieces(batch, text, piece_bytes):
                arrays = make(["" if t is None else t for t in piece.column(text).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in old), *arrays], names=[*old, *new.names])

    return mapped(docs, run, schema)


def pieces(batch, text: str, piece_bytes: int):
    """Slices of an Arrow batch with about ``piece_bytes`` of text each, of at least one row."""
    import numpy as np
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    start = 0
    while start < len(ends):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + piece_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def runs(batches, keys: int):
    """Tables of whole groups with the bounds of each; rows come sorted by the first ``keys`` columns, which a group shares."""
    import numpy as np
    import pyarrow as pa

    held = []

    def bounds(table):
        change = np.zeros(table.num_rows - 1, bool)
        for c in table.columns[:keys]:
            values = c.to_numpy()
            change |= values[1:] != values[:-1]
        return np.concatenate([[0], np.flatnonzero(change) + 1, [table.num_rows]])

    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch])
        cuts = bounds(table.combine_chunks())
        if len(cuts) > 2:
            yield table.slice(0, cuts[-2]), cuts[:-1]
        held = table.slice(cuts[-2]).to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, np.array([0, table.num_rows])


def groups(batches, keys: int):
    """Groups of rows with equal values in the first ``keys`` columns, as Arrow tables; rows come sorted by those."""
    for table, cuts in runs(batches, keys):
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield table.slice(a, b - a)


_SHIPPED: set[str] = set()


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)``, with this package sent along: workers need not have it installed."""
    context = df.sparkSession.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        context.addPyFile(shutil.make_archive(os.path.join(tempfile.mkdtemp(), package.name), "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)
    return df.mapInArrow(run, schema)
