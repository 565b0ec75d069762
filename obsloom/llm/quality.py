"""Line-first quality rules.

Each line with a word is judged alone; lines that fail are removed. A document is rejected if it
fails the base rules, or if the removed lines held more than ``max_lost`` percent of the code points
in its words. The rules of a line:

* punctuation: it must end with a closing mark or else hold one end of a sentence for every 60 words
  (running prose that breaks off), and have at most one run of symbols or of doubled marks for every
  four words;
* navigation: at most one separator of menus and tables for every four words;
* boilerplate: up to 40 words with a known phrase fail, and so does a line equal to an earlier one.

Defined results: null or empty text has no words and fails. Repeated rows are judged alike. Columns
of the input named as a column of the result are replaced.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

from obsloom.llm.common import SPACES, with_columns

SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?…:;\"'”’»)]。！？"
MARKS = r"[#*$%&<>=~^_{}]+|[!?]{2,}"
SENTENCE_ENDS = ".!?…。！？"
SENTENCE_WORDS = 60
SEPARATORS = "|»›·•"
PHRASES = (
    "all rights reserved", "accept cookies", "cookie policy", "privacy policy", "terms of service", "terms of use",
    "enable javascript", "subscribe to our", "click here", "sign in to", "log in to", "share on", "skip to content",
    "back to top", "licensed under", "released under",
)
PHRASE_WORDS = 40
MIN_WORDS = 50
MAX_REPEATED = 50
MAX_LOST = 40
FIELDS = (
    "cleaned string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "lost_chars long, base_failed boolean, kept boolean"
)


def repeated_words(codes) -> int:
    """Words in windows of three that the text has twice or more; ``codes`` numbers the words."""
    import numpy as np

    if len(codes) < 4:
        return 0
    kinds = int(codes.max()) + 1
    windows = codes[:-1] * kinds + codes[1:]
    if kinds**3 >= 1 << 63:  # number the pairs first, so that the product stays within 64 bits
        windows = np.unique(windows, return_inverse=True)[1].astype(np.int64)
    windows = windows[:-1] * kinds + codes[2:]
    ordered = np.sort(windows)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    found = np.isin(windows, again)
    covered = np.zeros(len(codes), bool)
    for shift in range(3):
        covered[shift : shift + len(found)] |= found
    return int(covered.sum())


def judge(max_lost: int = MAX_LOST):
    """A function from texts to the columns of ``FIELDS``."""
    import numpy as np
    import pyarrow as pa

    marks = re.compile(MARKS)

    def line_fails(line: str, n: int) -> bool:
        if line.rstrip(SPACES)[-1] not in TERMINAL and SENTENCE_WORDS * sum(map(line.count, SENTENCE_ENDS)) < n:
            return True
        if 4 * len(marks.findall(line)) > n:
            return True
        if 4 * sum(map(line.count, SEPARATORS)) > n:
            return True
        if n > PHRASE_WORDS:
            return False
        low = line.lower()
        return any(phrase in low for phrase in PHRASES)

    def measure(text: str) -> tuple:
        numbers: dict[bytes, int] = {}
        codes: list[int] = []
        kept, seen = [], set()
        dup_lines = lost = chars = 0
        for line in text.split("\n"):
            words = line.encode("utf-8", "surrogatepass").split()  # bytes are split at ASCII white space only
            if not words:
                kept.append(line)
                continue
            codes += [numbers.setdefault(w, len(numbers)) for w in words]
            size = len(line) - sum(map(line.count, SPACES))
            chars += size
            again = line in seen
            dup_lines += again
            seen.add(line)
            if again or line_fails(line, len(words)):
                lost += size
            else:
                kept.append(line)
        n = len(codes)
        repeat = repeated_words(np.array(codes, np.int64))
        failed = n < MIN_WORDS or 100 * repeat > MAX_REPEATED * n
        return (
            "\n".join(kept), n, chars, sum(map(text.count, SYMBOLS)), dup_lines, repeat, lost, failed,
            not failed and 100 * lost <= max_lost * chars,
        )

    types = [pa.string(), *[pa.int64()] * 6, pa.bool_(), pa.bool_()]

    def columns(texts: list[str]) -> list:
        measured = list(zip(*map(measure, texts), strict=True))
        return [pa.array(c, t) for c, t in zip(measured, types, strict=True)]

    return columns


def quality_rules(docs: DataFrame, text: str = "text", max_lost: int = MAX_LOST) -> DataFrame:
    """``docs`` with ``cleaned`` (the text without failed lines), what was measured on the whole text, and ``kept``."""
    return with_columns(docs, text, FIELDS, judge, max_lost)
