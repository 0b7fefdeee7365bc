"""Learned decision lists over text statistics, as ordered Spark conditions.

Statistics come from built-in functions alone. Sequential covering learns conjunctions of
thresholds that describe rejected rows: each is grown on two thirds of the labelled sample by
information gain, pruned on the rest, and kept while it is nearly always right there; rows it
covers are set aside and the next one is learned. The list becomes one `when` chain.

Null text has no words and fails the base rule. Without labelled rows of both kinds the list is
empty and only the base rule rejects. Repeated rows give a row each; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import SPACE, text_or_empty

#: Labelled rows, at most, that rules are learned from; chosen by a hash of the id, whole texts.
TRAIN_ROWS = 20_000
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
MAX_RULES, MAX_CONDITIONS, CUTS = 12, 4, 64
#: Share of right rejections that a rule must show on the rows it was pruned on, and rows it must cover there.
MIN_PRECISION, MIN_COVERED = 0.95, 5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What rules may compare, as shares so that a threshold means the same for any length.
FEATURES = {
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "bang_share": "n_bangs / greatest(n_words, 1)",
    "words": "CAST(n_words AS DOUBLE)",
}


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns, the base statistics, and what else the features need."""
    size = lambda column: F.size(column).cast("long")
    without = lambda characters: F.length(F.translate("_text", characters, "")).cast("long")
    chars = F.length("_text").cast("long")
    trimmed = F.btrim(F.col("_text"), F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    windows = F.when(
        F.col("n_words") >= 3,
        F.transform(F.slice("_words", 1, F.col("n_words").cast("int") - 2),
                    lambda word, i: F.xxhash64(word, F.get("_words", i + 1), F.get("_words", i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    placed = F.when(
        size(F.array_distinct("_windows")) < size(F.col("_windows")),
        F.sort_array(F.transform("_windows", lambda window, i: F.struct(window.alias("w"), i.alias("i")))),
    )
    twice = F.expr(
        "sort_array(transform(filter(_placed, (at, k) -> get(_placed, k - 1).w <=> at.w OR get(_placed, k + 1).w <=> at.w), at -> at.i))"
    )
    covered = F.expr("aggregate(transform(_twice, (at, k) -> least(3, coalesce(get(_twice, k + 1) - at, 3))), 0L, (n, more) -> n + more)")
    return (
        docs.select(*keep, text_or_empty(text).alias("_text"))
        .withColumns({"_words": words, "_lines": lines, "n_symbols": chars - without(SYMBOLS), "word_chars": without(BLANKS),
                      "n_bangs": chars - without("!"), "n_upper": F.length(F.regexp_replace("_text", r"[^\p{Lu}]+", "")).cast("long")})
        .withColumns({"n_words": size(F.col("_words")), "n_lines": size(F.col("_lines")),
                      "n_dup_lines": size(F.col("_lines")) - size(F.array_distinct("_lines"))})
        .withColumn("_windows", windows)
        .withColumn("_placed", placed)
        .withColumn("_twice", twice)
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
        # Generated rows: a later filter on a statistic then stays above, where each is a value and not its whole expression.
        .select(*keep, F.inline(F.array(F.struct(*BASE, "n_upper", "n_bangs", "n_lines"))))
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= F.lit(self.threshold) if self.above else value < F.lit(self.threshold)

    def holds(self, values: dict[str, np.ndarray]) -> np.ndarray:
        return values[self.feature] >= self.threshold if self.above else values[self.feature] < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, values: dict[str, np.ndarray], n: int) -> np.ndarray:
    return np.logical_and.reduce([c.holds(values) for c in rule]) if rule else np.ones(n, bool)


def _grow(values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), bool)
    while len(rule) < MAX_CONDITIONS and (~bad & inside).any():
        p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
        base, best, chosen = np.log2(p0 / (p0 + n0)), 1e-9, None
        for feature, column in values.items():
            own = column[inside]
            for cut in np.unique(np.quantile(own, np.linspace(0, 1, CUTS + 1))).tolist():
                for above in (True, False):
                    held = own >= cut if above else own < cut
                    p, n = (bad[inside] & held).sum(), (~bad[inside] & held).sum()
                    if p and (gain := p * (np.log2(p / (p + n)) - base)) > best:
                        best, chosen = gain, Condition(feature, above, cut)
        if chosen is None:
            break
        rule = (*rule, chosen)
        inside &= chosen.holds(values)
    return rule


def _prune(rule: Rule, values: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    def worth(part: Rule) -> float:
        held = _covers(part, values, len(bad))
        return ((bad & held).sum() - (~bad & held).sum()) / max(1, held.sum())

    parts = [rule[:n] for n in range(1, len(rule) + 1)]
    return max(parts, key=lambda part: (worth(part), -len(part)))


def learn(values: dict[str, np.ndarray], bad: np.ndarray, pruning: np.ndarray) -> list[Rule]:
    """Rules that describe bad rows, in order; `pruning` marks the rows held back for pruning."""
    rules: list[Rule] = []
    left = np.ones(len(bad), bool)
    while len(rules) < MAX_RULES:
        grow, prune = left & ~pruning, left & pruning
        if (bad & grow).sum() < MIN_COVERED or not (~bad & grow).any():
            break
        rule = _grow({k: v[grow] for k, v in values.items()}, bad[grow])
        if not rule:
            break
        rule = _prune(rule, {k: v[prune] for k, v in values.items()}, bad[prune])
        held = _covers(rule, values, len(bad))
        tested = held & prune
        if tested.sum() < MIN_COVERED or (bad & tested).sum() < MIN_PRECISION * tested.sum():
            break
        rules.append(rule)
        left &= ~held
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text",
                rows: int = TRAIN_ROWS) -> list[Rule]:
    """Rules for rows labelled 0 that pass the base rule."""
    marked = (
        labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1))
        .groupBy("_id").agg(F.min("_label").alias("_label"))
        .orderBy(F.xxhash64("_id"), "_id").limit(rows)
    )
    sample = docs.select(F.col(key).alias("_id"), F.col(text).alias("_body")).join(F.broadcast(marked), "_id")
    found = (
        statistics(sample, "_body", ("_id", "_label")).where(~base_failed())
        .select("_label", (F.pmod(F.xxhash64("_id", F.lit("prune")), F.lit(3)) == 0).alias("_prune"),
                *[F.expr(sql).alias(name) for name, sql in FEATURES.items()])
        .collect()
    )
    values = {name: np.array([row[name] for row in found], float) for name in FEATURES}
    return learn(values, np.array([row._label == 0 for row in found], bool), np.array([row._prune for row in found], bool))


def verdict(rules: list[Rule]) -> Column:
    """Which rule rejects a row (from 1), 0 for none."""
    chain = F.when(F.lit(False), F.lit(0))
    for number, rule in enumerate(rules, 1):
        whole = rule[0].column()
        for condition in rule[1:]:
            whole = whole & condition.column()
        chain = chain.when(whole, F.lit(number))
    return chain.otherwise(F.lit(0))


def judge(docs: DataFrame, rules: list[Rule], text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, statistics, base_failed, kept, rule) for every row."""
    return (
        statistics(docs, text, (key,))
        .withColumn("base_failed", base_failed())
        .withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
        .select(key, *BASE, "base_failed", "kept", "rule")
    )
