"""URL filters: host and path rules first, then the ratio of two character language models.

URLs that a rule decides teach two variable-order Markov models over characters, one of accepted and
one of rejected URLs. The probability of a character after its longest context is interpolated with
that after the next shorter one, down to even odds over 256 characters (Dirichlet smoothing), so
unseen contexts fall back by themselves. A URL's score is the difference of the two log-likelihoods
per character. The threshold is calibrated on the labelled URLs of a fold that the models do not
learn from: of the bin edges, the one with the least sum of both error rates.

Counts are made once for the longest grams; shorter ones are summed from those. Scores are made per
distinct gram and joined to the URLs' positions.

Defined results: a null URL or one without ``://`` has empty host and path; null is scored as an empty
text. If one of the models has nothing to learn from, or the fold lacks one of the verdicts, the
threshold is 0. Repeated rows are judged alike; every one teaches. Columns of the input named as a
column of the result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsloom.llm.common import ascii_lower, stored

ALLOW, BLOCK = "allow", "block"
Rules = Sequence[tuple[str, str]]
START, END = "\x02", "\x03"
#: Even odds below the shortest context.
ALPHABET = 256


def host_and_path(url: Column) -> tuple[Column, Column]:
    body = F.coalesce(url, F.lit(""))
    pattern = r"://([^/?#]*)([^?#]*)"
    return ascii_lower(F.regexp_extract(body, pattern, 1)), F.regexp_extract(body, pattern, 2)


def rule_for(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null without one."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(says)).otherwise(verdict)
    return found, verdict


def grams(url: Column, order: int) -> Column:
    """Every character of the URL and its end, each with the ``order`` characters before it."""
    padded = F.concat(F.lit(START * order), ascii_lower(F.coalesce(url, F.lit(""))), F.lit(END))
    return F.transform(F.sequence(F.lit(1), F.length(padded) - order), lambda i: F.substring(padded, i, F.lit(order + 1)))


def gram_scores(counts: DataFrame, order: int, prior: float) -> DataFrame:
    """``(gram, score)`` for every gram in ``counts (gram, allowed, blocked)``: the log of the two models' ratio."""
    out = counts.select("gram", *[F.lit(1.0 / ALPHABET).alias(f"p_{m}") for m in ("allowed", "blocked")])
    total = counts.agg(F.sum("allowed").alias("all_allowed"), F.sum("blocked").alias("all_blocked")).first()
    for k in range(order + 1):
        part, context = F.substring("gram", order + 1 - k, k + 1), F.substring("gram", order + 1 - k, k)
        seen = counts.groupBy(part.alias("part")).agg(F.sum("allowed").alias("n_allowed"), F.sum("blocked").alias("n_blocked"))
        out = out.withColumn("part", part).join(seen, "part").drop("part")
        if k:
            before = counts.groupBy(context.alias("context")).agg(F.sum("allowed").alias("c_allowed"), F.sum("blocked").alias("c_blocked"))
            out = out.withColumn("context", context).join(before, "context").drop("context")
        else:
            out = out.withColumns({f"c_{m}": F.lit(int(total[f"all_{m}"] or 0)) for m in ("allowed", "blocked")})
        out = out.select(
            "gram",
            *[((F.col(f"n_{m}") + prior * F.col(f"p_{m}")) / (F.col(f"c_{m}") + prior)).alias(f"p_{m}") for m in ("allowed", "blocked")],
        )
    return out.select("gram", (F.log("p_allowed") - F.log("p_blocked")).alias("score"))


def threshold(scored: DataFrame, width: float) -> float:
    """The bin edge with the least sum of both error rates on ``scored (score, says, rows)``; of equal ones that next to 0."""
    bins = scored.groupBy(F.floor(F.round(F.col("score") / width, 4)).alias("bin")).agg(
        *[F.sum(F.when(F.col("says") == v, F.col("rows")).otherwise(0)).alias(c) for v, c in ((ALLOW, "allowed"), (BLOCK, "blocked"))]
    )
    # One window without a key, over bins only: scores lie within log(256) of 0 by their base, a few thousand bins at any size.
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lost, caught = F.coalesce(F.sum("allowed").over(below), F.lit(0)), F.coalesce(F.sum("blocked").over(below), F.lit(0))
    all_allowed, all_blocked = F.sum("allowed").over(whole), F.sum("blocked").over(whole)
    edges = bins.select("bin", lost.alias("lost"), caught.alias("caught"), all_allowed.alias("a"), all_blocked.alias("b")).where("a > 0 and b > 0")
    best = edges.orderBy(F.round(F.col("lost") / F.col("a") - F.col("caught") / F.col("b"), 9), F.abs("bin"), "bin").select("bin").first()
    return best["bin"] * width if best else 0.0


def filter_urls(
    pages: DataFrame,
    rules: Rules,
    url: str = "url",
    order: int = 4,
    prior: float = 5.0,
    folds: int = 5,
    width: float = 0.01,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict``.

    ``order`` is the longest context, ``prior`` the weight of the next shorter one. One of ``folds``
    parts of the labelled URLs, by the md5 of the URL, calibrates; ``width`` is that of its bins.
    """
    host, path = host_and_path(F.col(url))
    judged = pages.withColumns({"host": host, "path": path})
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": rule, "__says": says, "__url": ascii_lower(F.coalesce(F.col(url), F.lit("")))})
    fold = F.conv(F.substring(F.md5("__url"), 1, 4), 16, 10).cast("int") % folds
    # Equal URLs are scored once.
    seen = stored(
        judged.groupBy(F.col("__url").alias("url"), F.col("__says").alias("says"), fold.alias("fold")).agg(F.count("*").alias("rows"))
    )
    learns = F.col("fold") != 0
    spread = seen.select("says", "rows", learns.alias("learns"), F.explode(grams(F.col("url"), order)).alias("gram"))
    counts = spread.groupBy("gram").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("learns") & (F.col("says") == v), F.col("rows"))), F.lit(0)).alias(c)
            for v, c in ((ALLOW, "allowed"), (BLOCK, "blocked"))
        ]
    )
    model = gram_scores(stored(counts), order, prior)
    # A URL goes by its 128-bit hash from here on, which is shorter than its text.
    key = F.struct(F.xxhash64("url").alias("h1"), F.xxhash64(F.lit("url"), "url").alias("h2"))
    positions = seen.select("url").distinct().select(key.alias("key"), F.explode(grams(F.col("url"), order)).alias("gram"))
    scored = stored(positions.join(model, "gram").groupBy("key").agg(F.avg("score").alias("score")))
    fold_rows = seen.where("fold = 0 and says is not null").select(key.alias("key"), "says", "rows")
    limit = threshold(fold_rows.join(scored, "key"), width)
    own = F.struct(F.xxhash64("__url").alias("h1"), F.xxhash64(F.lit("url"), "__url").alias("h2"))
    left = judged.withColumn("__key", own).join(scored.select(F.col("key").alias("__of"), F.col("score").alias("__score")), F.col("__key") == F.col("__of"), "left")
    return left.withColumns(
        {
            "score": F.col("__score"),
            "verdict": F.coalesce(F.col("__says"), F.when(F.round("__score", 9) >= F.lit(limit), F.lit(ALLOW)).otherwise(F.lit(BLOCK))),
        }
    ).drop("__says", "__url", "__key", "__of", "__score")
