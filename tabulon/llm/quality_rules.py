"""Operator 8: quality rules as a learned decision list, in DataFrame functions only.

``with_statistics`` measures every whole text.  ``learn`` grows an ordered list
of rules for low quality by sequential covering: a rule is a conjunction of
thresholds, grown one condition at a time by information gain on the growing
rows, cut back on the pruning rows, and kept if it is precise on both; rows it
covers are set aside and the next rule is grown.  Where a rule is imprecise, its first kind of condition (a feature
and a side) begins further rules only with thresholds that are precise on the growing rows, and the search goes on.  All labelled rows are used:
they are reduced once to counts per cell of quantile bins, which grow finer towards both ends and
follow the low rows as well as all rows, so that rare kinds and heavy tails have thresholds of their own; the last
threshold of a rule is then moved out within its bin, up to the nearest good row.  Each growing step
is one aggregation to at most ``features * bins`` rows.  ``verdict`` emits the list as
one ordered Spark conditional expression.

Null and empty texts have no words: they fail the base rule.  Labels that are
null or without a document are not used; a document labelled twice counts twice.
Without labelled rows of both kinds the list is empty and the method keeps all.
A statistic on a zero base (no words, no lines) is 0.  Repeated rows are judged alike.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulon.llm.common import ASCII_SPACE, columns, fresh
from tabulon.session import stage

#: Words per window of the repetition measure.
WINDOW = 8
#: Characters counted as symbols (fixed by the contract).
SYMBOLS = r"[#*$%&|<>]"
#: Base rule (fixed by the contract): least words, most percent of words in repeated windows.
LEAST_WORDS = 20
MOST_REPEATED = 30

#: The outermost bins hold a share of 2 to the power of minus this many of the rows (10,000 is the quantiles' accuracy).
TAIL_BITS = 13

#: Statistics that rules may test, from the measured counts.
FEATURES = {
    "words": "cast(n_words as double)",
    "mean_word": "coalesce(try_divide(word_chars, n_words), 0d)",
    "symbol_share": "coalesce(try_divide(n_symbols, word_chars), 0d)",
    "upper_share": "coalesce(try_divide(n_upper, word_chars), 0d)",
    "distinct_share": "coalesce(try_divide(n_distinct_words, n_words), 0d)",
    "dup_line_share": "coalesce(try_divide(n_dup_lines, n_lines), 0d)",
    "repeat_share": "coalesce(try_divide(n_repeat_words, n_words), 0d)",
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_distinct_words",
          "n_lines")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def test(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def with_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns ``COUNTS`` (which it must not have)."""
    t, w, h, s, p = fresh(docs, "whole_text", "word_list", "windows", "sorted_windows", "repeat_starts")
    blank = r"' \u0009\u000a\u000b\u000c\u000d'"
    measured = (
        docs.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
        .withColumn(w, F.expr(f"trim(BOTH {blank} FROM {t})"))
        .withColumn(w, F.when(F.col(w) == "", F.array().cast("array<string>"))
                    .otherwise(F.split(F.col(w), f"{ASCII_SPACE}+")))
        .withColumn("n_words", F.size(w).cast("long"))
        # one 64-bit hash for each window of words
        .withColumn(h, F.expr(f"if(n_words < {WINDOW}, cast(array() as array<bigint>), transform("
                              f"sequence(1, cast(n_words as int) - {WINDOW - 1}), "
                              f"i -> xxhash64(slice({w}, i, {WINDOW}))))"))
        # windows with their places in order of hash, where some hash occurs twice
        .withColumn(s, F.expr(f"if(size(array_distinct({h})) = size({h}), "
                              "cast(array() as array<struct<x: bigint, i: int>>), "
                              f"sort_array(transform({h}, (x, i) -> named_struct('x', x, 'i', i))))"))
        .withColumn(p, F.expr(f"sort_array(transform(filter({s}, (v, j) -> v.x <=> get({s}, j - 1).x "
                              f"or v.x <=> get({s}, j + 1).x), v -> v.i))"))
        .withColumn("n_repeat_words", F.expr(
            f"aggregate(transform({p}, (x, j) -> least({WINDOW}, coalesce(get({p}, j + 1) - x, {WINDOW}))), "
            "0L, (sum, x) -> sum + x)"))
        .withColumn("word_chars", F.length(F.array_join(w, "")).cast("long"))
        .withColumn("n_distinct_words", F.size(F.array_distinct(w)).cast("long"))
        .withColumn("n_symbols", F.regexp_count(t, F.lit(SYMBOLS)).cast("long"))
        .withColumn("n_upper", F.length(F.regexp_replace(t, "[^A-Z]+", "")).cast("long"))
        .withColumn(h, F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
        .withColumn("n_lines", F.size(h).cast("long"))
        .withColumn("n_dup_lines", (F.col("n_lines") - F.size(F.array_distinct(h))).cast("long")))
    return measured.select(*docs.columns, *COUNTS)


# learning ---------------------------------------------------------------------------


def _cells(labelled: DataFrame, bins: int) -> tuple[DataFrame, dict[str, list[float]]]:
    """Counts of low and good rows per cell of quantile bins and fold; the threshold above each bin.

    A threshold lies half way between the largest value of its bin and the next value that occurs.
    """
    ends = [2.0 ** -i for i in range(math.ceil(math.log2(bins)), TAIL_BITS + 1)]
    shares = sorted({*(i / bins for i in range(1, bins)), *ends, *(1 - x for x in ends)})
    values = labelled.select("low", "fold", *(F.expr(e).alias(f) for f, e in FEATURES.items()))
    row = values.agg(*(F.percentile_approx(value, shares, 10_000).alias(f"{f}_{i}") for f in FEATURES
                       for i, value in enumerate((F.col(f), F.when(F.col("low"), F.col(f)))))).first()
    cuts = {f: sorted({*(row[f"{f}_0"] or []), *(row[f"{f}_1"] or [])}) for f in FEATURES}

    def bin_of(feature: str) -> Column:
        bounds = F.lit(cuts[feature]).cast("array<double>")
        return F.size(F.filter(bounds, lambda x: x < F.col(feature))).alias(feature)

    binned = values.select("low", "fold", *map(bin_of, FEATURES))
    least: dict[str, dict[int, float]] = {f: {} for f in FEATURES}
    seen = values.select(F.explode(F.array(*[
        F.struct(F.lit(f).alias("f"), bin_of(f).alias("bin"), F.col(f).alias("x")) for f in FEATURES])).alias("v"))
    for row in seen.groupBy("v.f", "v.bin").agg(F.min("v.x")).collect():  # at most features * bins rows
        least[row[0]][row[1]] = row[2]
    thresholds = {f: [(x + min((v for b, v in least[f].items() if b > at), default=x)) / 2
                      for at, x in enumerate(cuts[f])] for f in FEATURES}
    counted = binned.groupBy("fold", *FEATURES).agg(
        F.sum(F.when(F.col("low"), 1).otherwise(0)).alias("low"),
        F.sum(F.when(F.col("low"), 0).otherwise(1)).alias("good"))
    return stage(counted, "cells"), thresholds


def _in_bins(rule: list[tuple[str, bool, int]]) -> Column:
    """Cells that a rule covers; a condition tests the bin number."""
    out = F.lit(True)
    for feature, above, at in rule:
        out = out & (F.col(feature) > at if above else F.col(feature) <= at)
    return out


def _gain(low: int, good: int, low0: int, good0: int) -> float:
    """Information gain of narrowing (low0, good0) rows to (low, good)."""
    if not low:
        return 0.0
    return low * (math.log2(low / (low + good)) - math.log2(low0 / (low0 + good0)))


def _bin_counts(cells: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
    """Low and good rows per feature and bin, from one aggregation to at most features * bins rows."""
    stacked = cells.select("low", "good", F.explode(F.array(
        *[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in FEATURES])).alias("v"))
    counts: dict[str, dict[int, tuple[int, int]]] = {f: {} for f in FEATURES}
    for row in stacked.groupBy("v.f", "v.bin").agg(F.sum("low"), F.sum("good")).collect():
        counts[row[0]][row[1]] = (row[2], row[3])
    return counts


def _best_condition(counts: dict[str, dict[int, tuple[int, int]]], cuts: dict[str, list[float]], low0: int, good0: int,
                    allowed: Callable[[tuple[str, bool, int], int, int], bool] = lambda *_: True):
    """The ``allowed`` threshold with the most gain, by the ``counts`` of the rows so far."""
    best = None
    for feature in FEATURES:
        low = good = 0
        for at in range(len(cuts[feature])):
            x, y = counts[feature].get(at, (0, 0))
            low, good = low + x, good + y
            for above, a, b in ((False, low, good), (True, low0 - low, good0 - good)):
                gain = _gain(a, b, low0, good0)
                if gain > 1e-9 and (best is None or gain > best[0]) and allowed((feature, above, at), a, b):
                    best = gain, (feature, above, at), a, b
    return best


def _widened(labelled: DataFrame, earlier: list[Rule], rule: Rule) -> Rule:
    """``rule`` with its last threshold half way to the nearest good row outside it, wherever its bin ends.

    Only low rows lie between, so it grows no less precise; two aggregations to a row each.
    """
    *others, last = rule
    rows = labelled.filter(verdict(earlier)).select("low", F.expr(FEATURES[last.feature]).alias("x"),
                                                    *(c.test().alias(f"t{i}") for i, c in enumerate(others)))
    for i in range(len(others)):
        rows = rows.filter(f"t{i}")
    nearest, furthest = (F.max, F.min) if last.above else (F.min, F.max)
    outside = F.col("x") <= last.threshold if last.above else F.col("x") > last.threshold
    good = rows.agg(nearest(F.when(outside & ~F.col("low"), F.col("x")))).first()[0]
    if good is None:
        return rule
    beyond = F.col("x") > good if last.above else F.col("x") < good
    low = rows.agg(furthest(F.when(beyond, F.col("x")))).first()[0]
    if low is None:
        return rule
    middle = (good + low) / 2
    threshold = min(middle, last.threshold) if last.above else max(min(middle, math.nextafter(good, -math.inf)), last.threshold)
    return (*others, Condition(last.feature, last.above, threshold))


def learn(statistics: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          bins: int = 48, most_rules: int = 12, most_conditions: int = 4, most_failed: int = 16,
          precision: float = 0.95, support: int = 3) -> list[Rule]:
    """Rules for low quality (label 0), in order, from all labelled rows of ``statistics``.

    A rule must reach ``precision`` on the pruning rows (a third, by hash of the
    id) and on the growing rows, and cover ``support`` low rows in all, one of the pruning rows among them.
    After ``most_failed`` rules in a row that do not, the list ends.
    """
    known = labels.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col), (F.col(label_col) == 0).alias("low"))
    labelled = (statistics.select(id_col, *COUNTS).join(known, id_col)
                .withColumn("fold", F.when(F.pmod(F.xxhash64(id_col), F.lit(3)) == 0, "prune").otherwise("grow")))
    labelled = stage(labelled, "labelled")
    cells, cuts = _cells(labelled, bins)
    rest = cells
    rules: list[Rule] = []
    imprecise: set[tuple[str, bool]] = set()
    refuted: set[tuple[str, bool, int]] = set()

    def may_begin(condition: tuple[str, bool, int], low: int, good: int) -> bool:
        return condition not in refuted and (condition[:2] not in imprecise or low >= precision * (low + good))

    failed, begin = 0, None  # `begin`: counts of all growing rows left; a failed rule leaves them as they are
    while len(rules) < most_rules and failed < most_failed:
        grow = rest.filter("fold = 'grow'")
        begin = begin or _bin_counts(grow)
        low, good = (sum(x[i] for x in begin[next(iter(FEATURES))].values()) for i in (0, 1))
        if not low:
            break
        rule: list[tuple[str, bool, int]] = []
        while len(rule) < most_conditions and good:
            best = (_best_condition(_bin_counts(grow.filter(_in_bins(rule))), cuts, low, good) if rule
                    else _best_condition(begin, cuts, low, good, may_begin))
            if best is None:
                break
            rule.append(best[1])
            low, good = best[2], best[3]
        if not rule:
            break
        sums = [F.coalesce(F.sum(F.when(_in_bins(rule[:n]) & (F.col("fold") == fold), F.col(kind))), F.lit(0))
                for n in range(1, len(rule) + 1) for fold in ("prune", "grow") for kind in ("low", "good")]
        row = rest.agg(*sums).first()
        scores = []
        for n in range(len(rule)):
            low_p, good_p, low_g, good_g = row[4 * n:4 * n + 4]
            worth = (low_p - good_p) / (low_p + good_p) if low_p + good_p else -1.0
            scores.append((worth, -n, low_p, good_p, low_g, good_g))
        worth, n, low_p, good_p, low_g, good_g = max(scores)
        precise = all(a >= precision * (a + b) for a, b in ((low_p, good_p), (low_g, good_g)))
        if not precise or not low_p or low_p + low_g < support:
            imprecise.add(rule[0][:2])
            refuted.add(rule[0])
            failed += 1
            continue
        failed, begin = 0, None
        rule = rule[:1 - n]
        rules.append(_widened(labelled, rules, tuple(Condition(f, above, cuts[f][at]) for f, above, at in rule)))
        rest = rest.filter(~_in_bins(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The decision list as one ordered conditional: true where no rule rejects."""
    if not rules:
        return F.lit(True)
    out = None
    for rule in rules:
        test = rule[0].test()
        for condition in rule[1:]:
            test = test & condition.test()
        out = F.when(test, False) if out is None else out.when(test, False)
    return out.otherwise(True)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (the id), ``COUNTS``, ``base_failed`` and ``kept`` of every row of ``docs``."""
    keep = keep or [id_col]
    stored = stage(with_statistics(docs.select(*dict.fromkeys([*keep, id_col, text_col])), text_col)
                   .select(*dict.fromkeys([*keep, id_col]), *COUNTS), "statistics")
    rules = learn(stored, labels, id_col)
    return (stored.withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & verdict(rules))
            .select(*keep, *COUNTS, "base_failed", "kept"))


def accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that neither the base rule nor the learned list rejects, all columns as they are.

    Texts are measured twice, once to learn and once to judge, so that none is stored or shuffled.
    """
    rows = docs.select(F.struct(*columns(docs.columns)).alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    measured = with_statistics(rows)
    rules = learn(stage(measured.select("id", *COUNTS), "statistics"),
                  labels.select(F.col(id_col).alias("id"), "quality"), "id")
    # the generator keeps the filter above the measuring, whose steps it would otherwise repeat
    counts = F.inline(F.array(F.struct(*COUNTS)))
    return measured.select("row", counts).filter(~base_failed() & verdict(rules)).select("row.*")
