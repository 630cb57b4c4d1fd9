"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Each rule looks at one feature of a text and votes good (1), votes bad (-1) or abstains (0); some
rules only know signs of bad texts and never vote good. How far to trust a rule is not set but
estimated: given the votes of all documents, expectation-maximisation alternates between each
document's probability of being good and how often each rule votes either way on good and on bad
documents. A vote counts by the log ratio of those rates, an abstention not at all. A document is
kept where the posterior is at least ``LEAST``, whatever single rules say.

The documents enter the estimate as counts by pattern of votes, of which there are at most
3 ** rules; each round is one aggregation over those. All features are column functions over whole
texts, inside the row: no text moves.

Defined results: a missing or empty text has 0 words, fails the base rules and is not kept; ties
of the posterior keep the document; repeated rows are judged alike, each counted; an empty table
gives no rows; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame, functions as F

from headway.llm.common import words, written

SYMBOLS = "#*$%&|<>"   # fixed values
BASE_WORDS = 50
BASE_REPEAT = 50       # per cent of the words
LEAST = 0.5
ROUNDS = 20
SETTLED = 1e-3
START_PRIOR = 0.85
# How often a rule votes (for, against) on good and on bad documents, to begin with, and how many
# documents' worth of that each class keeps.
START = {"good": (0.6, 0.02), "bad": (0.3, 0.3)}
STRENGTH = 5.0


@dataclass(frozen=True)
class Rule:
    """Votes good up to ``good`` (from it on, if ``rising``) and bad beyond ``bad``."""

    name: str
    feature: str
    bad: float
    good: float | None = None
    rising: bool = False

    def vote(self) -> Column:
        x = F.col(self.feature)
        vote = F.when(x < self.bad if self.rising else x > self.bad, -1)
        if self.good is not None:
            vote = vote.when(x >= self.good if self.rising else x <= self.good, 1)
        return vote.otherwise(0)


RULES = (
    Rule("length", "n_words", 50, 100, rising=True),
    Rule("letters", "letter_share", 0.75, 0.95, rising=True),
    Rule("variety", "distinct_share", 0.25, 0.5, rising=True),
    Rule("symbols", "symbol_share", 0.04),
    Rule("repeats", "repeat_share", 0.3),
    Rule("duplicate_lines", "dup_line_share", 0.4),
    Rule("short_words", "word_length", 2.2, rising=True),
    Rule("long_words", "word_length", 15.0),
)


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, the base counts and the shares that rules look at."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), body.alias("body"),
                       words(body).alias("words"))
    # A window of three words is known by a hash of them: the windows of one text are few enough.
    windows = F.transform(
        F.slice("words", F.lit(1), F.greatest(F.size("words") - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)))
    lines = F.filter(F.split("body", "\n", -1), lambda x: F.translate(x, " \t\n\x0b\x0c\r", "") != "")
    rows = rows.select("doc_id", "body", "words", windows.alias("windows"), lines.alias("lines"))
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.char_length("body") - F.char_length(F.translate("body", SYMBOLS, "")))
        .cast("long").alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("words")).alias("n_distinct"),
        F.regexp_count("body", F.lit(r"\p{L}")).alias("n_letters"),
        F.when(twice, F.sort_array(placed)).alias("ordered"))
    rows = rows.withColumn("n_repeat_words", _covered("ordered")).drop("ordered")
    some, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("n_repeat_words") / some).alias("repeat_share"),
        (F.col("n_symbols") / chars).alias("symbol_share"),
        (F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))).alias("dup_line_share"),
        (F.col("word_chars") / some).alias("word_length"),
        # Long texts repeat words by nature: variety is measured against the root of the length.
        F.least(F.lit(1.0), F.col("n_distinct") / F.least(some, F.lit(12) * F.sqrt(some)))
        .alias("distinct_share"),
        (F.col("n_letters") / chars).alias("letter_share"))


def _covered(ordered: str) -> Column:
    """Words in windows found twice or more, from the windows' hashes in order with their places:
    those beside an equal one are repeated, and each adds the words the one before did not."""
    again = F.filter(ordered, lambda x, i: (
        F.get(ordered, i - 1).h.eqNullSafe(x.h) | F.get(ordered, i + 1).h.eqNullSafe(x.h)))
    places = F.sort_array(F.transform(again, lambda x: x.i))
    begin = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
    total = F.aggregate(places, begin, lambda s, i: F.struct(
        i.alias("last"), (s.n + F.least(F.lit(3), i - s.last)).alias("n")), lambda s: s.n)
    return F.coalesce(total, F.lit(0).cast("long"))


def base_failed() -> Column:
    return ((F.col("n_words") < BASE_WORDS)
            | (100 * F.col("n_repeat_words") > BASE_REPEAT * F.col("n_words")))


@dataclass
class Estimate:
    """Share of good documents, and each rule's rates of votes (for, against) on either kind."""

    prior: float
    good: list[tuple[float, float]]
    bad: list[tuple[float, float]]

    def weights(self) -> dict[str, float]:
        """Log odds that a document is good: of any, and by each rule's vote for and against.
        A rule is never taken to mean the opposite of what it says."""
        out = {"w": log(self.prior / (1 - self.prior))}
        for i, (g, b) in enumerate(zip(self.good, self.bad)):
            out[f"for{i}"] = max(0.0, log(g[0] / b[0]))
            out[f"against{i}"] = min(0.0, log(g[1] / b[1]))
        return out

    def judged(self, votes: DataFrame) -> DataFrame:
        """``votes`` with ``posterior``. A rule's weights are a table looked up by its vote (the
        odds of any document are part of the first), which the compiled plan takes as data: every
        round runs the same one. No vote weighs nothing."""
        now = self.weights()
        tables = [[now[f"against{i}"], 0.0, now[f"for{i}"]] for i in range(len(self.good))]
        tables[0] = [now["w"] + x for x in tables[0]]
        odds = reduce(Column.__add__, [F.get(F.lit(table), F.coalesce(f"v{i}", F.lit(0)) + 1)
                                       for i, table in enumerate(tables)])
        return votes.withColumn("posterior", 1 / (1 + F.exp(-odds)))


def estimate(patterns: DataFrame, rules: int, rounds: int = ROUNDS) -> Estimate:
    """Expectation-maximisation over ``patterns`` (v0, v1, ..., n), a row per pattern of votes."""
    now = Estimate(START_PRIOR, [START["good"]] * rules, [START["bad"]] * rules)
    for _ in range(rounds):
        weighed = now.judged(patterns).select(
            "*", (F.col("n") * F.col("posterior")).alias("good"),
            (F.col("n") * (1 - F.col("posterior"))).alias("bad"))
        sums = weighed.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"), *[
            F.sum(F.when(F.col(f"v{i}") == vote, F.col(kind)).otherwise(0.0)).alias(f"{kind}{vote}_{i}")
            for i in range(rules) for vote in (1, -1) for kind in ("good", "bad")]).first()
        if sums["good"] is None:
            break

        def rates(kind: str) -> list[tuple[float, float]]:
            return [tuple((sums[f"{kind}{vote}_{i}"] + STRENGTH * start) / (sums[kind] + STRENGTH)
                          for vote, start in zip((1, -1), START[kind])) for i in range(rules)]

        share = (sums["good"] + STRENGTH) / (sums["good"] + sums["bad"] + 2 * STRENGTH)
        then = Estimate(min(0.99, max(0.01, share)), rates("good"), rates("bad"))
        before, after = now.weights(), then.weights()
        now = then
        if max(abs(after[k] - before[k]) for k in after) < SETTLED:
            break
    return now


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text",
          rules: tuple[Rule, ...] = RULES, least: float = LEAST) -> DataFrame:
    """``doc_id``, the base counts, ``base_failed``, ``posterior`` and ``kept``."""
    found = features(docs, key, text)
    votes = [r.vote().alias(f"v{i}") for i, r in enumerate(rules)]
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    voted = written(found.select(*names, base_failed().alias("base_failed"), *votes), "quality-votes")
    patterns = written(voted.groupBy(*[f"v{i}" for i in range(len(rules))])
                       .agg(F.count(F.lit(1)).alias("n")).coalesce(1), "quality-patterns")
    return estimate(patterns, len(rules)).judged(voted).select(
        *names, "base_failed", "posterior",
        (~F.col("base_failed") & (F.col("posterior") >= least)).alias("kept"))
