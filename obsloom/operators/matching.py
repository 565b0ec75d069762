"""Matching two lists of place names by the words they share inside the same region.

Names repeat, so equal (regions, words) combinations are scored once, on both sides. Words that
very many right-hand names share are handled apart: a pair is looked up through a rarer word it
shares. For pairs that share nothing but common words, the best partner of a set of words is the
best of its subsets that some right-hand name contains, so both sides are joined on subsets: work
grows with the names times the subsets of a name's few common words, not with pairs of names. The
best match is exact either way; no candidate is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsloom.functions.text import word_tokens
from obsloom.operators.ranking import best_per_key
from obsloom.operators.skew import lookup_join
from obsloom.session import materialise

COMMON_WORD_ROWS = 100
DIRECT_PAIRS = 20_000_000
#: Sets of up to so many common words are joined on their subsets.
SUBSET_WORDS = 8
SCORES = ["total_matched_chars", "matched_token_count"]
SCORES_NO_STOP = ["total_matched_chars_no_city", "matched_token_count_no_city"]


def _words(text) -> Column:
    """The non-empty words of a text with how often each occurs, in word order."""
    words = F.array_sort(F.filter(word_tokens(text), lambda w: w != ""))
    return F.transform(
        F.array_distinct(words),
        lambda w: F.struct(w.alias("token"), F.size(F.filter(words, lambda x: x == w)).alias("times")),
    )


def _scores(chars: Column, times: Column, token: Column, stop: str) -> list[Column]:
    plain = token != stop
    return [
        F.sum(chars * times).alias(SCORES[0]),
        F.sum(times).alias(SCORES[1]),
        F.sum(F.when(plain, chars * times).otherwise(0)).alias(SCORES_NO_STOP[0]),
        F.sum(F.when(plain, times).otherwise(0)).alias(SCORES_NO_STOP[1]),
    ]


def _pair_scores(left: DataFrame, right: DataFrame, by: list[str], spread: list[str], stop: str, extra=()) -> DataFrame:
    """Join word rows on region and word, and add up the scores per ``by``."""
    pairs = lookup_join(left, right, ["state", "token"], "inner", spread=spread)
    times = (F.col("left_times") * F.col("right_times")).cast("bigint")
    chars = F.length("token").cast("bigint")
    return pairs.groupBy(*by).agg(*_scores(chars, times, F.col("token"), stop), *extra)


def _exploded(df: DataFrame, words: str, side: str, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.explode(words).alias("_w")).select(
        *keep, F.col("_w.token").alias("token"), F.col("_w.times").alias(f"{side}_times")
    )


def token_match(
    left: DataFrame,
    right: DataFrame,
    *,
    left_id: str,
    left_text: str,
    left_regions: Column,
    right_id: str,
    right_text: str,
    right_region: Column,
    stop_word: str = "city",
    common_rows: int = COMMON_WORD_ROWS,
    direct_pairs: int = DIRECT_PAIRS,
    left_as: str | None = None,
    right_as: str | None = None,
) -> DataFrame:
    """Best right row per left row, with its scores with and without the stop word.

    ``left_regions`` is an array (a left row may span several regions). A word is common when
    more than ``common_rows`` distinct right names of a region have it; common words are handled
    apart when joining on all words would give more than ``direct_pairs`` pairs. Score: characters in
    shared words, counting repeats on both sides, then number of shared words, then lowest id.
    """
    regions = F.array_sort(F.array_distinct(F.filter(left_regions, lambda r: r.isNotNull())))
    left_rows = left.select(
        F.col(left_id).alias("_left"), regions.alias("_regions"), _words(left_text).alias("_words")
    ).withColumn("_name", F.md5(F.to_json(F.struct("_regions", "_words"))))
    left_names = left_rows.groupBy("_name").agg(F.first("_regions").alias("_regions"), F.first("_words").alias("_words"))
    left_names = left_names.select("_name", F.explode("_regions").alias("state"), "_words")

    # One row per distinct name, read several times below.
    right_names = materialise(
        right.select(F.col(right_id).alias("_right"), right_region.alias("state"), _words(right_text).alias("_words"))
        .filter(F.col("state").isNotNull())
        .groupBy("state", "_words")
        .agg(F.min("_right").alias("_right"))
    )
    left_words = _exploded(left_names, "_words", "left", ["_name", "state"])
    right_words = _exploded(right_names, "_words", "right", ["_right", "state"])
    frequency = right_words.groupBy("state", "token").agg(F.count(F.lit(1)).alias("_n"))
    if _joined_pairs(left_words, frequency) <= direct_pairs:
        scored = _pair_scores(left_words, right_words, ["_name", "_right"], ["_name"], stop_word)
    else:
        common = materialise(frequency.filter(F.col("_n") > common_rows).select("state", "token"))
        scored = _scored_apart(left_names, right_names, common, stop_word)
    best = materialise(best_per_key(scored, ["_name"], SCORES, ["_right"], SCORES_NO_STOP))
    matched = lookup_join(left_rows.select("_left", "_name"), best, ["_name"], "inner", spread=["_left"])
    return matched.select(
        F.col("_left").alias(left_as or left_id), F.col("_right").alias(right_as or right_id), *SCORES, *SCORES_NO_STOP
    )


def _joined_pairs(left_words: DataFrame, frequency: DataFrame) -> float:
    """How many pairs a join on region and word gives, from the counts per word."""
    other = left_words.groupBy("state", "token").agg(F.count(F.lit(1)).alias("_m"))
    pairs = other.join(frequency, ["state", "token"]).agg(F.sum(F.col("_n").cast("double") * F.col("_m")))
    return pairs.first()[0] or 0.0


def _split_words(names: DataFrame, ids: list[str], common: DataFrame, side: str) -> DataFrame:
    """Word rows marked common or not, each with its name's set of common words."""
    words = _exploded(names, "_words", side, ids)
    marked = lookup_join(
        words, common.withColumn("_common", F.lit(True)), ["state", "token"], "left", spread=[ids[0]]
    ).withColumn("_common", F.coalesce("_common", F.lit(False)))
    sets = marked.groupBy(*ids).agg(
        F.array_sort(
            F.collect_list(F.when(F.col("_common"), F.struct("token", F.col(f"{side}_times").alias("times"))))
        ).alias(f"{side}_set"),
        F.collect_list(
            F.when(~F.col("_common"), F.struct("token", F.col(f"{side}_times").alias("times")))
        ).alias("_rare"),
    )
    return sets


def _set_score(left_set: str, right_set: str, stop: str) -> list[Column]:
    """Scores of two sets of common words, as expressions."""

    def total(value) -> Column:
        def of_word(a):
            return F.aggregate(
                F.filter(right_set, lambda b: b.token == a.token),
                F.lit(0).cast("bigint"),
                lambda acc, b: acc + value(a, b).cast("bigint"),
            )

        return F.aggregate(left_set, F.lit(0).cast("bigint"), lambda acc, a: acc + of_word(a))

    def times(a, b):
        return a.times * b.times

    def chars(a, b):
        return F.length(a.token) * a.times * b.times

    def unless_stop(f):
        return lambda a, b: F.when(a.token != stop, f(a, b)).otherwise(0)

    return [total(f) for f in (chars, times, unless_stop(chars), unless_stop(times))]


def _subsets(words: str) -> Column:
    """All subsets of an array of at most ``SUBSET_WORDS`` elements but the empty one, in its order."""
    return F.expr(f"transform(sequence(1, shiftleft(1, size({words})) - 1), m -> filter({words}, (w, i) -> getbit(m, i) = 1))")


def _by_subsets(left_sets: DataFrame, right_sets: DataFrame, stop: str) -> DataFrame:
    """Per left set and subset that right names contain: the lowest id of these and the subset's scores.

    A pair's score is that of all it shares, which is one of the subsets; other subsets score less.
    """
    tokens = F.transform("_some", lambda w: w.token)

    def total(value) -> Column:
        return F.aggregate("_some", F.lit(0).cast("bigint"), lambda acc, w: acc + value(w).cast("bigint"))

    def unless_stop(value):
        return lambda w: F.when(w.token != stop, value(w)).otherwise(0)

    def chars(w):
        return F.length(w.token) * w.times

    def times(w):
        return w.times

    held = right_sets.select("state", "_right", F.explode(_subsets("right_set")).alias("_some"))
    held = held.groupBy("state", tokens.alias("_tokens")).agg(F.min("_right").alias("_right"))
    asked = left_sets.select("state", "left_set", F.explode(_subsets("left_set")).alias("_some"))
    scores = [total(f).alias(n) for f, n in zip((chars, times, unless_stop(chars), unless_stop(times)), SCORES + SCORES_NO_STOP, strict=True)]
    asked = asked.select("state", "left_set", tokens.alias("_tokens"), *scores)
    return asked.join(held, ["state", "_tokens"]).select("state", "left_set", "_right", *SCORES, *SCORES_NO_STOP)


def _scored_apart(left_names: DataFrame, right_names: DataFrame, common: DataFrame, stop: str) -> DataFrame:
    # Each is read several times below.
    left = materialise(_split_words(left_names, ["_name", "state"], common, "left"))
    right = materialise(_split_words(right_names, ["_right", "state"], common, "right"))
    names = SCORES + SCORES_NO_STOP

    # Pairs that share a rarer word: their common words are added from the carried sets.
    rare = _pair_scores(
        _exploded(left, "_rare", "left", ["_name", "state", "left_set"]),
        _exploded(right, "_rare", "right", ["_right", "state", "right_set"]),
        ["_name", "_right"],
        ["_name"],
        stop,
        extra=[F.first("left_set").alias("left_set"), F.first("right_set").alias("right_set")],
    )
    rare = rare.select(
        "_name",
        "_right",
        *[(F.col(n) + s).alias(n) for n, s in zip(names, _set_score("left_set", "right_set", stop), strict=True)],
    )

    # Pairs that share common words only. For a pair counted above as well, the score here is
    # the lower one and loses against it.
    left_sets = left.filter(F.size("left_set") > 0).select("state", "left_set").distinct()
    right_sets = (
        right.filter(F.size("right_set") > 0).groupBy("state", "right_set").agg(F.min("_right").alias("_right"))
    )
    # On subsets: sets of few words, the right-hand ones without repeats (a left-hand one cannot know how often
    # the other side repeats a word). The few others are scored pair by pair.
    few_left = F.size("left_set") <= SUBSET_WORDS
    few_right = (F.size("right_set") <= SUBSET_WORDS) & F.forall("right_set", lambda w: w.times == 1)

    def by_pairs(some_left: DataFrame, some_right: DataFrame) -> DataFrame:
        return _pair_scores(
            _exploded(some_left, "left_set", "left", ["state", "left_set"]),
            _exploded(some_right, "right_set", "right", ["state", "_right"]),
            ["state", "left_set", "_right"],
            ["left_set"],
            stop,
        )

    between = (
        by_pairs(left_sets, right_sets.filter(~few_right))
        .unionByName(by_pairs(left_sets.filter(~few_left), right_sets.filter(few_right)))
        .unionByName(_by_subsets(left_sets.filter(few_left), right_sets.filter(few_right), stop))
    )
    best_set = materialise(best_per_key(between, ["state", "left_set"], SCORES, ["_right"], SCORES_NO_STOP))
    shared = lookup_join(
        left.select("_name", "state", "left_set"), best_set, ["state", "left_set"], "inner", spread=["_name"]
    ).select("_name", "_right", *names)
    return rare.unionByName(shared)
