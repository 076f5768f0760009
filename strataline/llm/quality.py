"""Quality rules: a decision list learned from labelled statistics, applied as one Spark conditional expression.

Statistics of a text are DataFrame expressions over whole texts. Sequential covering learns, from a bounded
sample of labelled rows, an ordered list of conjunctions of thresholds that reject: each rule is grown on two
thirds of the rows by FOIL's information gain, pruned from its end on the other third, and kept while it is
precise there; covered rows leave, and the next rule is learned. What no rule rejects is kept.

Defined cases: a null or empty text has zero words and fails the base rules; labels that are null are ignored,
and of several labels of a document the lowest counts; without labelled rows of both kinds the list is empty;
repeated documents get repeated rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.llm.common import SPACE, let, text_or_empty, thinned
from strataline.session import stage

BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# What the learner sees: ratios of the counts that stats() makes.
FEATURES = {
    "mean_word_chars": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "word_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "upper_share": ("n_upper", "word_chars"),
    "digit_share": ("n_digits", "word_chars"),
    "stop_share": ("n_stops", "n_words"),
    "distinct_share": ("n_distinct_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
    "words": ("n_words", None),
}


def _matching(text: str, others: str) -> Column:
    """Characters of a text that are none of ``others``, a negated character class."""
    return F.length(F.regexp_replace(text, others, ""))


def _repeat_words(words: str) -> Column:
    """Words inside windows that occur twice or more. Windows are compared by 64-bit hashes, after sorting."""

    def at(array: Column, i: Column) -> Column:
        return F.get(array, i)

    hashes = F.transform(
        F.sequence(F.lit(0), F.size(words) - WINDOW),
        lambda i: F.xxhash64(*[at(F.col(words), i + k) for k in range(WINDOW)]),
    )

    def covered(starts: Column) -> Column:
        step = F.transform(
            starts, lambda s, k: F.least(F.coalesce(at(starts, k + 1) - s, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(step, F.lit(0), lambda a, b: a + b)

    def repeated_starts(ranked: Column) -> Column:
        return F.transform(
            F.filter(
                F.transform(
                    ranked,
                    lambda e, k: F.struct(
                        e["i"].alias("i"),
                        F.coalesce(
                            (at(ranked, k - 1)["h"] == e["h"]) | (at(ranked, k + 1)["h"] == e["h"]), F.lit(False)
                        ).alias("twice"),
                    ),
                ),
                lambda e: e["twice"],
            ),
            lambda e: e["i"],
        )

    def count(h: Column) -> Column:
        # Most texts repeat no window: for them sorting plain numbers is enough.
        has_repeat = let(F.sort_array(h), lambda s: F.size(F.filter(s, lambda x, k: (k > 0) & (at(s, k - 1) == x))) > 0)
        ranked = F.array_sort(F.transform(h, lambda x, k: F.struct(x.alias("h"), k.alias("i"))))
        return F.when(has_repeat, let(let(ranked, lambda r: F.array_sort(repeated_starts(r))), covered)).otherwise(0)

    return F.when(F.size(words) > WINDOW, let(hashes, count)).otherwise(0)


def stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its column ``id_col`` and the counts that rules are made of."""
    text = docs.select(id_col, text_or_empty(text_col).alias("text"))
    trimmed = F.btrim("text", F.lit(BLANKS))
    split = text.select(
        id_col,
        "text",
        F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "").alias("lines"),
    )
    return split.select(
        id_col,
        F.size("words").alias("n_words"),
        F.length(F.array_join("words", "")).alias("word_chars"),
        _matching("text", r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        _repeat_words("words").alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        _matching("text", r"[^A-Z]+").alias("n_upper"),
        _matching("text", r"[^0-9]+").alias("n_digits"),
        _matching("text", r"[^.!?]+").alias("n_stops"),
        F.size(F.array_distinct("words")).alias("n_distinct_words"),
    ).select(id_col, *[F.col(c).cast("long").alias(c) for c in STATS])


STATS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits",
    "n_stops", "n_distinct_words",
)


def feature(name: str) -> Column:
    """A feature as an expression over the counts; ratios of nothing are zero."""
    over, under = FEATURES[name]
    if under is None:
        return F.col(over).cast("double")
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(F.lit(0.0))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


class Condition(NamedTuple):
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = feature(self.feature)
        return value >= self.threshold if self.above else value < self.threshold

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        v = values[self.feature]
        return v >= self.threshold if self.above else v < self.threshold


Rule = tuple[Condition, ...]


@dataclass(frozen=True)
class Learner:
    """Parameters of sequential covering. ``fit_rows`` bounds the labelled rows that reach the driver."""

    fit_rows: int = 20_000
    cuts: int = 64
    max_conditions: int = 4
    max_rules: int = 12
    min_precision: float = 0.9
    min_rejected: int = 5
    seed: int = 7

    def learn(self, values: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
        rng = np.random.default_rng(self.seed)
        left = np.ones(len(bad), dtype=bool)
        rules: list[Rule] = []
        while len(rules) < self.max_rules and (left & bad).sum() >= self.min_rejected:
            grow = left & (rng.random(len(bad)) < 2 / 3)
            rule = self._prune(self._grow(values, bad, grow), values, bad, left & ~grow)
            hit = self._covered(rule, values, left)
            if not rule or not (hit & bad).any():
                break
            check = hit & ~grow
            # A rule too small for the pruning rows to judge is judged on all rows that are left.
            judged = check if check.sum() >= self.min_rejected else hit
            if (hit & bad).sum() < self.min_rejected or bad[judged].mean() < self.min_precision:
                break
            rules.append(rule)
            left &= ~hit
        return rules

    def _covered(self, rule: Rule, values: dict[str, np.ndarray], among: np.ndarray) -> np.ndarray:
        hit = among.copy()
        for condition in rule:
            hit &= condition.holds(values)
        return hit

    def _grow(self, values: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
        rule: Rule = ()
        hit = rows.copy()
        while len(rule) < self.max_conditions and (hit & ~bad).any() and (hit & bad).any():
            p0, n0 = (hit & bad).sum(), (hit & ~bad).sum()
            best, best_gain = None, 1e-9
            for name, v in values.items():
                v, y = v[hit], bad[hit]
                order = np.argsort(v, kind="stable")
                v, below = v[order], np.concatenate([[0], np.cumsum(y[order])])
                cuts = np.unique(np.quantile(v, np.linspace(0, 1, self.cuts + 2)[1:-1]))
                at = np.searchsorted(v, cuts, side="left")
                for above in (False, True):
                    p = p0 - below[at] if above else below[at]
                    n = (len(v) - at if above else at) - p
                    with np.errstate(divide="ignore", invalid="ignore"):
                        gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1.0)
                    if len(gain) and gain.max() > best_gain:
                        best_gain = float(gain.max())
                        best = Condition(name, above, float(cuts[int(gain.argmax())]))
            if best is None:
                break
            rule = (*rule, best)
            hit &= best.holds(values)
        return rule

    def _prune(self, rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray, rows: np.ndarray) -> Rule:
        def worth(r: Rule) -> float:
            hit = self._covered(r, values, rows)
            return (2 * (hit & bad).sum() - hit.sum()) / max(1, hit.sum())

        # The longest of the best prefixes.
        return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (worth(r), len(r)), default=())


def fit(counted: DataFrame, labels: DataFrame, learner: Learner = Learner(), id_col: str = "doc_id") -> list[Rule]:
    """The decision list for statistics of ``stats`` and a table of (id, quality), 1 for good."""
    known = labels.filter(F.col("quality").isNotNull()).groupBy(id_col).agg(F.min("quality").alias("quality"))
    at = F.xxhash64(id_col)
    rows = (
        counted.filter(~base_failed())
        .join(known, id_col)
        # Thinned by a hash before the exact bound, so that no task or driver sorts all labelled rows.
        .filter(thinned(at, learner.fit_rows, known.count()))
        .select((F.col("quality") < 1).alias("bad"), *[feature(f).alias(f) for f in FEATURES], at.alias("at"))
        .orderBy("at", *FEATURES)
        .limit(learner.fit_rows)
        .collect()
    )
    if not rows:
        return []
    values = {f: np.array([r[f] for r in rows], dtype=float) for f in FEATURES}
    return learner.learn(values, np.array([r["bad"] for r in rows], dtype=bool))


def verdict(rules: list[Rule]) -> Column:
    """The list as one ordered conditional: the number of the first rule that rejects, 0 if none does."""
    out = None
    for number, rule in enumerate(rules, 1):
        condition = rule[0].column()
        for more in rule[1:]:
            condition = condition & more.column()
        out = F.when(condition, number) if out is None else out.when(condition, number)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, labels: DataFrame, learner: Learner = Learner()) -> DataFrame:
    """Statistics of every document, ``base_failed``, ``rule`` (number of the rejecting rule or 0) and ``kept``."""
    counted = stage(stats(docs), "quality")
    rules = fit(counted, labels, learner)
    return (
        counted.withColumn("base_failed", base_failed())
        .withColumn("rule", verdict(rules).cast("int"))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )


def keep(docs: DataFrame, labels: DataFrame, learner: Learner = Learner()) -> DataFrame:
    """The documents that neither the base rules nor the learned ones reject, with all their columns.

    Statistics are made twice, for learning and for deciding, which is cheaper than moving texts to a join. Beside
    the second ones stands a row number: a filter is never pushed below it, into the expressions of the counts,
    where each mention of a count would compute it again, and splitting a text again for every word.
    """
    rules = fit(stage(stats(docs), "quality"), labels, learner)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text")
    counted = stats(whole, id_col="doc").withColumn("row", F.monotonically_increasing_id())
    return counted.filter((F.col("row") >= 0) & ~base_failed() & (verdict(rules) == 0)).select("doc.*")
