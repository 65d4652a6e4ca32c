"""Quality rules: text statistics as DataFrame expressions and a learned decision list over them.

All statistics of a text are computed in its own row, whatever its length, without a shuffle.  The list is learned by
sequential covering: a rule is grown from threshold conditions (the one with the best information gain first) on part of
the labelled rows, pruned from its end on the others, kept if it is precise there, and the rows it covers are taken
away before the next one.  It comes out as one ordered conditional expression of Spark.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, least_hashes

WINDOW = 8
SAMPLE = 20_000  # labelled rows that the list is learned from, at most
MARGIN = 4  # labelled ids that are looked at for each row of the sample
MAX_RULES, MAX_CONDITIONS, CUTS = 12, 4, 24
PRECISION = 0.9  # of a rule on the pruning rows (Laplace-corrected)
FEATURES = ("n_words", "mean_word", "symbol_share", "digit_share", "dup_line_share", "repeat_share", "distinct_share", "line_words")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with the base counts and the ``FEATURES``.

    Null and empty texts have no words: all counts and shares are 0.  8-word windows are compared by 64-bit hashes
    within one text.
    """
    names = [c for c in docs.columns if c != text]
    keep = [F.col(f"`{c}`") for c in names]
    blank = " \t\n\x0b\x0c\r"
    words = F.when(F.col("__t") == "", F.array().cast("array<string>")).otherwise(F.split("__t", r"[\x20\x09-\x0D]+"))
    raw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    d = docs.select(*keep, raw.alias("__r")).withColumn("__t", F.btrim("__r", F.lit(blank)))
    d = d.withColumn("__w", words).withColumn("__lines", F.filter(F.split("__r", "\n"), lambda x: F.btrim(x, F.lit(blank)) != ""))
    n = F.size("__w")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("__w", i, WINDOW))))
    d = d.select(
        *keep,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
        F.regexp_count("__t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("__t", F.lit("[0-9]")).cast("long").alias("__digits"),
        F.size("__lines").cast("long").alias("__n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("__w")).cast("long").alias("__distinct"),
        windows.alias("__h"),
    )
    again = F.size(F.array_distinct("__h")) < F.size("__h")
    d = d.withColumn("__s", F.when(again, F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    last = F.size("__s")

    def twice(i: Column) -> Column:
        own = F.element_at("__s", i)["h"]
        return ((i > 1) & (F.element_at("__s", F.greatest(i - 1, F.lit(1)))["h"] == own)) | ((i < last) & (F.element_at("__s", F.least(i + 1, last))["h"] == own))

    places = F.sort_array(F.transform(F.filter(F.sequence(F.lit(1), last), twice), lambda i: F.element_at("__s", i)["i"]))
    d = d.withColumn("__places", F.when(F.col("__s").isNotNull(), places)).drop("__s", "__h")
    start = F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n"))
    covered = F.aggregate("__places", start, lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(p - a["at"], F.lit(WINDOW))).alias("n")), lambda a: a["n"])
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return d.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("__digits", "word_chars").alias("digit_share"),
        share("n_dup_lines", "__n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("__distinct", "n_words").alias("distinct_share"),
        share("n_words", "__n_lines").alias("line_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    cut: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c >= F.lit(self.cut) if self.at_least else c <= F.lit(self.cut)

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.cut if self.at_least else x[self.feature] <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]


def _covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), dtype=bool)
    for c in rule:
        out &= c.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray) -> Rule:
    rule: Rule = ()
    inside = np.ones(len(bad), dtype=bool)
    while len(rule) < MAX_CONDITIONS and (inside & ~bad).any():
        p0, all0 = (inside & bad).sum(), inside.sum()
        best = (1e-9, None)
        for f in FEATURES:
            for cut in np.unique(np.quantile(x[f][inside], np.linspace(0, 1, CUTS))):
                for at_least in (True, False):
                    c = Condition(f, at_least, float(cut))
                    now = inside & c.holds(x)
                    p, every = (now & bad).sum(), now.sum()
                    if p and every < all0:
                        gain = p * (math.log2(p / every) - math.log2(p0 / all0))
                        if gain > best[0]:
                            best = (gain, c)
        if best[1] is None:
            break
        rule = (*rule, best[1])
        inside &= best[1].holds(x)
    return rule


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> tuple[float, float]:
    """(gain, Laplace precision) of a rule on the pruning rows."""
    covered = _covers(rule, x)
    p, n = float((covered & bad).sum()), float((covered & ~bad).sum())
    return (p - n) / max(p + n, 1.0), (p + 1) / (p + n + 2)


def learn(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Ordered rules that cover bad rows; none if the rows have one class only."""
    rules: list[Rule] = []
    grow_rows = np.arange(len(bad)) % 3 != 0
    part = lambda rows: {f: v[rows] for f, v in x.items()}
    left = np.ones(len(bad), dtype=bool)
    while len(rules) < MAX_RULES and (left & bad & grow_rows).any() and (left & ~bad).any():
        rows = left & grow_rows
        rule = _grow(part(rows), bad[rows])
        if not rule:
            break
        rows = left & ~grow_rows
        held, truth = part(rows), bad[rows]
        shorter = [rule[:k] for k in range(len(rule), 0, -1)]
        rule = max(shorter, key=lambda r: (_worth(r, held, truth)[0], len(r)))
        if _worth(rule, held, truth)[1] < PRECISION:
            break
        rules.append(rule)
        left &= ~_covers(rule, x)
    return rules


def fit(statistics: DataFrame, labels: DataFrame, id_col: str = "doc_id", label: str = "quality") -> list[Rule]:
    """Learn from at most ``SAMPLE`` labelled rows, chosen by a hash of the id, that pass the base rules.

    Only the ids with the least hashes, about ``MARGIN * SAMPLE``, are joined and ordered, so what tasks send on does not
    grow with their number; if the base rules drop most of these, the sample is smaller.

    Null labels and ids are left out; an id with several labels counts as bad if one of them is 0.  Without labelled
    rows of both kinds the list is empty, and the base rules decide alone.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull()).groupBy(id_col).agg(F.min(label).alias("__good"))
    order = F.xxhash64(id_col)
    rows = (
        statistics.where(~base_failed())
        .join(known.where(least_hashes(order, known.count(), MARGIN * SAMPLE)), id_col)
        .select("__good", *FEATURES, order.alias("__order"), F.col(id_col).alias("__id"))
        .orderBy("__order", "__id", *FEATURES)
        .limit(SAMPLE)
        .collect()
    )
    x = {f: np.array([float(r[f]) for r in rows]) for f in FEATURES}
    return learn(x, np.array([r["__good"] == 0 for r in rows], dtype=bool)) if rows else []


def verdict(rules: list[Rule]) -> Column:
    """True unless a rule of the ordered list says no."""
    out: Column | None = None
    for rule in rules:
        condition = rule[0].column()
        for c in rule[1:]:
            condition &= c.column()
        out = F.when(condition, F.lit(False)) if out is None else out.when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: the base counts, ``base_failed`` and ``kept``."""
    statistics = checkpoint(text_statistics(docs.select(F.col(id_col), F.col(text)), text))
    rules = fit(statistics, labels, id_col)
    failed = base_failed()
    return statistics.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & verdict(rules)).alias("kept"),
    )
