"""Quality rules by weak supervision, in DataFrame operations only.

Every rule votes good or bad, or abstains. Expectation-maximisation over the counts of vote patterns estimates without
labels how reliable each rule is; the posterior probability of "good" decides, instead of an all-must-pass filter.
The pattern table has at most ``2 ** len(RULES)`` rows whatever the corpus size, and is all that reaches the driver.

Edge cases: null text counts as no words and fails the base rules; an empty table gives an empty result; repeated
rows are judged each on its own; other columns of the input are ignored (``quality_votes``) or passed (``keep_good``).
"""
from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.runtime import stage

#: White space that separates words, and the symbols counted.
SPACE = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
#: Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = ["the", "of", "and", "to", "in", "is", "that", "it", "de", "la", "le", "les", "des", "et", "en", "un",
                  "une", "der", "die", "das", "und", "ist", "nicht", "zu", "von", "el", "los", "las", "que", "y"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS = 50


def _removed(text: Column, chars: str) -> Column:
    """Number of code points of ``text`` that are in ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows whose words occur in an earlier or later window too."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))

    def twice(rows: Column) -> Column:
        same = lambda x, j: F.get(rows, j)["h"] == x["h"]
        return F.filter(rows, lambda x, j: F.coalesce(same(x, j - 1), F.lit(False)) | F.coalesce(same(x, j + 1), F.lit(False)))

    # the one-element array binds the sorted windows to a variable, so that they are sorted once
    hits = F.get(F.transform(F.array(F.sort_array(windows)), twice), F.lit(0))
    starts = F.sort_array(F.transform(hits, lambda x: x["i"]))
    covered = F.aggregate(starts, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                          lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(3), i - a["last"])).alias("n")),
                          lambda a: a["n"])
    return F.when(F.size(words) >= 4, covered).otherwise(F.lit(0)).cast("long")


def quality_features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` with the counts of the base rules and of the voting rules."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(*keep, text.alias("_text")).select(
        *keep, "_text", F.array_remove(F.split(F.translate("_text", SPACE, " " * len(SPACE)), " "), "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0).alias("_lines"))
    return split.select(
        *keep, F.size("_words").cast("long").alias("n_words"),
        (F.length("_text") - _removed(F.col("_text"), SPACE)).cast("long").alias("word_chars"),
        _removed(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"), _removed(F.col("_text"), UPPER).cast("long").alias("n_upper"),
        _removed(F.col("_text"), "!").cast("long").alias("n_bangs"),
        _removed(F.col("_text"), ".?").cast("long").alias("n_stops"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct"),
        F.size(F.array_intersect(F.col("_words"), F.array(*map(F.lit, FUNCTION_WORDS)))).cast("long").alias("n_function"))


def _vote(bad: str, good: str) -> Column:
    return F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0)


#: name -> vote when, and which vote; else the rule abstains. Every kind of junk is seen by two rules at least.
RULES = {
    "symbols": (-1, "10 * n_symbols > n_words"),
    "symbol_share": (-1, "50 * n_symbols > word_chars"),
    "repeats": (-1, "100 * n_repeat_words > 30 * n_words"),
    "vocabulary": (-1, "3 * n_distinct < n_words and n_words < 400"),
    "dup_lines": (-1, "2 * n_dup_lines > n_lines"),
    "upper": (-1, "3 * n_upper > word_chars"),
    "shouting": (-1, "10 * n_bangs > n_words"),
    "no_sentences": (-1, "200 * n_stops < n_words"),
    "sentences": (1, "50 * n_stops >= n_words and 2 * n_stops <= n_words"),
    "function_words": (1, "n_function >= 2"),
}


def quality_votes(features: DataFrame) -> DataFrame:
    """Adds ``base_failed``, and ``pattern``: which RULES vote, as one number in base 2."""
    code = F.lit(0)
    for _, when in RULES.values():
        code = code * 2 + F.expr(when).cast("int")
    return features.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 50 * n_words")) \
                   .withColumn("pattern", code.cast("int"))


def fit_posteriors(counts: dict[int, int], rounds: int = 100) -> dict[int, float]:
    """Posterior of "good" by vote pattern: EM for how often each rule votes in either class, and the share of good rows.

    Rules are first taken to vote for the wrong class one time in twenty, and never get more likely to vote for the
    wrong class than for the right one; this fixes which class is the good one.
    """
    signs = [v for v, _ in RULES.values()]
    votes = {p: [p >> (len(signs) - 1 - j) & 1 for j in range(len(signs))] for p in counts}
    total = sum(counts.values())
    rate = [(0.3, 0.05) if v < 0 else (0.3, 0.9) for v in signs]  # of voting in a bad, in a good row
    share, post = 0.8, {}
    for _ in range(rounds if total else 0):
        for p, v in votes.items():
            odds = math.log(share / (1 - share))
            for (bad, good), x in zip(rate, v):
                odds += math.log(good / bad) if x else math.log((1 - good) / (1 - bad))
            post[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        n_good = sum(n * post[p] for p, n in counts.items())
        share = min(0.99, max(0.01, n_good / total))
        for j, v in enumerate(signs):
            # one row of the starting belief is added to either class
            good = (rate[j][1] + sum(n * post[p] for p, n in counts.items() if votes[p][j])) / (1 + n_good)
            bad = (rate[j][0] + sum(n * (1 - post[p]) for p, n in counts.items() if votes[p][j])) / (1 + total - n_good)
            bad, good = (max(bad, good), good) if v < 0 else (min(bad, good), good)
            rate[j] = (min(0.999, max(0.001, bad)), min(0.999, max(0.001, good)))
    return post


def posterior_table(votes: DataFrame) -> DataFrame:
    """pattern, posterior: one row per vote pattern seen among rows that pass the base rules.

    Failed rows are dropped from the counts, not from ``votes``: a filter would be pushed below the projection that splits
    the texts, and run the splitting anew for every word.
    """
    seen = votes.groupBy("pattern", "base_failed").count().collect()  # at most 2 ** (1 + len(RULES)) rows
    post = fit_posteriors({r["pattern"]: r["count"] for r in seen if not r["base_failed"]})
    return votes.sparkSession.createDataFrame(sorted(post.items()), "pattern int, posterior double")


def _decide(votes: DataFrame, table: DataFrame, threshold: float) -> DataFrame:
    # one condition that needs the joined posterior: parts of it would be pushed below and make the counts run anew for each word
    judged = F.coalesce(F.when(F.col("base_failed"), -1.0).otherwise(F.col("posterior")), F.lit(-1.0))
    return votes.join(F.broadcast(table), "pattern", "left").withColumn("kept", judged >= threshold) \
                .withColumn("posterior", F.when(F.col("base_failed"), 0.0).otherwise(F.col("posterior")))


def quality_rules(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the base counts, base_failed, posterior and kept."""
    votes = stage(quality_votes(quality_features(docs, ["doc_id"])), "quality-votes")
    return _decide(votes, posterior_table(votes), threshold).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def keep_good(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that the rules keep, with the columns they came with."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))
    votes = stage(quality_votes(quality_features(row, ["_row"])).select("_row", "pattern", "base_failed"), "quality-votes")
    return _decide(votes, posterior_table(votes), threshold).where("kept").select("_row.*")
