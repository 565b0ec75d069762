"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell of source, language and topic. The cells' weights are raked: each sweep
scales them to the target shares of the sources, then of the languages, then of the topics. A
document's inclusion probability is its cell's raked weight per token, times one factor that makes
the expected number of kept tokens the asked share of all, and at most 1. A document is kept when
a number drawn from the md5 of its id lies below its probability.

Where a cell would need a probability above 1, it is kept whole and stays short of its raked weight, and the
sample misses the targets by as much: no value can have more than its share of the input over ``keep_share``.

Only sums per cell are ever shuffled for the fit, so a source with a third of all rows is one row
per partition and cell.

Defined results: null source, language or id count as empty texts; null text has no tokens. A cell
without tokens takes the factor 1. Rows that repeat an id share one decision. Columns of the input
named as a column of the result are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.llm.common import WORD, stored, unit

#: Topic by the first pattern found in the text; "general" without any.
TOPICS = (
    ("legal", r"(?i)licensed under|rights reserved|released under"),
    ("contact", r"[A-Za-z0-9._]+@[A-Za-z0-9]|\d{3}\.\d{1,3}\.\d{1,3}"),
    ("table", r" \| [^|\n]+ \| "),
    ("figures", r"\d"),
)


def topic_of(text: Column, topics=TOPICS) -> Column:
    out = F.lit("general")
    for name, pattern in reversed(topics):
        out = F.when(text.rlike(pattern), F.lit(name)).otherwise(out)
    return out


def target_shares(cells: DataFrame, margin: str, target: float | Mapping[str, float]) -> DataFrame:
    """``(margin, target)``: shares that sum to 1. A number is the power to which observed shares are raised
    (1 keeps them, 0 makes them equal); a mapping gives weights by value, values it lacks get none."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("tokens")).where("tokens > 0")
    if isinstance(target, Mapping):
        given = F.create_map(*[F.lit(x) for pair in target.items() for x in pair])
        sums = sums.withColumn("target", F.coalesce(F.try_element_at(given, F.col(margin)), F.lit(0.0)))
    else:
        sums = sums.withColumn("target", F.pow(F.col("tokens").cast("double"), F.lit(float(target))))
    total = sums.agg(F.sum("target").alias("total")).first()["total"] or 1.0
    return stored(sums.select(margin, (F.col("target") / F.lit(float(total))).alias("target")))


def rake(cells: DataFrame, targets: Mapping[str, float | Mapping[str, float]], sweeps: int) -> DataFrame:
    """``cells`` with ``weight``: shares of all tokens whose sums per margin approach the targets."""
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    shares = {margin: target_shares(cells, margin, target) for margin, target in targets.items()}
    cells = cells.withColumn("weight", F.col("tokens").cast("double") / F.lit(float(total)))
    for _ in range(sweeps):
        for margin, share in shares.items():
            sums = cells.groupBy(margin).agg(F.sum("weight").alias("now")).join(share, margin)
            sums = sums.select(margin, F.when(F.col("now") > 0, F.col("target") / F.col("now")).otherwise(0.0).alias("factor"))
            # Stored each time: a plan that read its own sums again would double with every margin.
            cells = stored(cells.join(sums, margin, "left").withColumn("weight", F.col("weight") * F.coalesce("factor", F.lit(0.0))).drop("factor"))
    return cells


def keep_factor(cells: DataFrame, keep_share: float, points: int = 16, rounds: int = 5) -> float:
    """The factor ``x`` at which the sum of tokens * min(1, x * rate) is ``keep_share`` of all tokens.

    Each round evaluates a grid of factors in equal ratios, in one aggregation, and goes on in the piece
    that holds the answer; inside the last piece the sum is taken as linear, which it is between two kinks.
    """
    some = cells.where("tokens > 0 and rate > 0")
    least, slope, total = some.agg(F.min("rate"), F.sum(F.col("tokens") * F.col("rate")), F.sum("tokens")).first()
    if least is None:
        return 1.0
    wanted = keep_share * cells.agg(F.sum("tokens")).first()[0]
    low, high = wanted / slope, 1.0 / least  # without any probability cut at 1, and with all of them
    if wanted >= total or low >= high:
        return high
    at_low = at_high = float(total)
    for _ in range(rounds):
        grid = [low * (high / low) ** (i / points) for i in range(points + 1)]
        sums = some.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("rate") * F.lit(x))).alias(f"s{i}") for i, x in enumerate(grid)]).first()
        above = next((i for i, s in enumerate(sums) if i and s > wanted), points)
        low, high, at_low, at_high = grid[above - 1], grid[above], sums[above - 1], sums[above]
        if at_high <= at_low:
            break
    return low + (high - low) * min(1.0, max(0.0, wanted - at_low) / (at_high - at_low)) if at_high > at_low else low


def annotated(docs: DataFrame, text: str = "text", topics=TOPICS) -> DataFrame:
    """``docs`` with ``topic`` and ``n_tokens`` (words), the two things that mixing needs of a text."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({"topic": topic_of(body, topics), "n_tokens": F.regexp_count(body, F.lit(WORD)).cast("long")})


def mix(
    docs: DataFrame,
    targets: Mapping[str, float | Mapping[str, float]] | None = None,
    keep_share: float = 0.7,
    sweeps: int = 6,
    doc_id: str = "doc_id",
    source: str = "source",
    lang: str = "lang",
) -> DataFrame:
    """``docs``, as :func:`annotated` gives them, with ``weight`` (raked weight per token against the input's), ``probability`` and ``kept``.

    ``targets`` has for ``source``, ``lang`` and ``topic`` what :func:`target_shares` takes. The rows are
    written once, so that texts are searched for words and topics once, not for the sums and again for
    the sample; drop the text before if the result does without.
    """
    targets = targets or {"source": 0.7, "lang": 0.7, "topic": 0.7}
    names = {"source": source, "lang": lang, "topic": "topic"}
    cell = F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(margin) for margin, c in names.items()])
    docs = stored(docs)
    cells = docs.select(cell.alias("cell"), "n_tokens").select("cell.*", F.col("n_tokens").alias("tokens"))
    cells = stored(cells.groupBy("source", "lang", "topic").agg(F.sum("tokens").alias("tokens")))
    raked = rake(cells, targets, sweeps)
    total = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    raked = stored(raked.withColumn("rate", F.when(F.col("tokens") > 0, F.col("weight") * F.lit(total) / F.col("tokens")).otherwise(1.0)))
    factor = keep_factor(raked, keep_share)
    rates = raked.select(F.struct("source", "lang", "topic").alias("__of"), F.col("rate").alias("__rate"))
    joined = docs.withColumn("__cell", cell).join(rates, F.col("__cell") == F.col("__of"), "left")
    joined = joined.withColumns({"weight": F.col("__rate"), "probability": F.least(F.lit(1.0), F.col("__rate") * F.lit(factor))})
    joined = joined.drop("__cell", "__of", "__rate")
    return joined.withColumn("kept", unit(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) < F.col("probability"))
