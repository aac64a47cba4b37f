"""Quality rules: a decision list learned from labelled statistics by sequential covering.

A rule is a conjunction of thresholds on document statistics. Rules that reject a document
are grown condition by condition on one part of the labelled rows, pruned on the rest, and
emitted in order as one Spark ``CASE`` expression. Counting runs as Spark aggregates; the
driver sees counts by statistic, bin and label only.

Defined results: a null or empty text has no words and all statistics are 0; repeated rows
are judged one by one; a row without ``doc_id`` is judged like any other; without labelled
rows of both kinds the list is empty and keeps everything that passes the base rules.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacegrid.llm.common import let, only_columns, written

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL_RUN = r"[^#*$%&|<>]+"

#: Rows of ``labels`` that the list is learned from at most, chosen by a hash of the id.
LABELLED_ROWS = 20_000
BINS = 32
MAX_RULES = 8
MAX_CONDITIONS = 4
#: A rule has to be right on this share of the rows that it was not grown on.
MIN_PRECISION = 0.9
MIN_COVERED = 5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics that rules may use, from the columns of ``statistics``.
FEATURES = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "mean_word_chars": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
}


@dataclass(frozen=True)
class Condition:
    """``feature > cut`` or ``feature <= cut``; ``place`` is the bin of the cut."""

    feature: str
    above: bool
    cut: float
    place: int

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.cut!r}D"

    def on_bins(self) -> Column:
        at = F.col(f"bin_{self.feature}")
        return at > self.place if self.above else at <= self.place


Rule = tuple[Condition, ...]


def repeated_words(words: Column) -> Column:
    """Words that stand in a three-word window found twice or more.

    Windows are sorted by hash and position packed in one number; neighbours of equal hash
    are compared word by word. Time is that of a sort, also for very long texts.
    """

    def covered(keys: Column, shift: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("bigint"), shift) - 1

        def at(key: Column) -> Column:
            return key.bitwiseAND(low).cast("int")

        def same(a: Column, b: Column) -> Column:
            close = F.call_function("shiftright", a, shift) == F.call_function("shiftright", b, shift)
            equal = [F.get(words, at(a) + k) == F.get(words, at(b) + k) for k in range(3)]
            return F.coalesce(close & equal[0] & equal[1] & equal[2], F.lit(False))

        twice = F.filter(
            keys, lambda key, i: same(key, F.get(keys, i - 1)) | same(key, F.get(keys, i + 1))
        )
        places = F.sort_array(F.transform(twice, at))
        start = F.struct(F.lit(-3).alias("before"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            places,
            start,
            lambda acc, p: F.struct(
                p.alias("before"),
                (acc["n"] + F.least(F.lit(3), p - acc["before"])).alias("n"),
            ),
            lambda acc: acc["n"],
        )

    def of_windows(shift: Column) -> Column:
        high = F.call_function("shiftleft", F.lit(-1).cast("bigint"), shift)
        keys = F.transform(
            F.slice(words, 1, F.size(words) - 2),
            lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
            .bitwiseAND(high)
            .bitwiseOR(i.cast("bigint")),
        )
        return let(F.sort_array(keys), lambda sorted_keys: covered(sorted_keys, shift))

    bits = F.ceil(F.log2(F.size(words) + 1)).cast("int")
    return F.when(F.size(words) > 3, let(bits, of_windows)).otherwise(F.lit(0).cast("bigint"))


def statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with word, symbol, line and repetition counts; one row per row."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.regexp_extract_all(body, F.lit(WORD), 0)
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD))

    def line_counts(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("bigint").alias("n_lines"),
            (F.size(found) - F.size(F.array_distinct(found))).cast("bigint").alias("n_dup_lines"),
        )

    def word_counts(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("bigint").alias("n_words"),
            F.length(F.array_join(found, "")).cast("bigint").alias("word_chars"),
            F.size(F.array_distinct(found)).cast("bigint").alias("n_distinct_words"),
            repeated_words(found).alias("n_repeat_words"),
        )

    symbols = F.length(F.regexp_replace(body, SYMBOL_RUN, "")).cast("bigint")
    return (
        documents.withColumn("_words", let(words, word_counts))
        .withColumn("_lines", let(lines, line_counts))
        .withColumn("n_symbols", symbols)
        .select(
            *(documents[c] for c in documents.columns if c not in {*BASE, "n_lines", "n_distinct_words"}),
            "_words.*",
            "n_symbols",
            "_lines.*",
        )
    )


def labelled_statistics(documents: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """Statistics of at most ``rows`` labelled documents, with ``bad`` and the ``fold``."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    mix = F.xxhash64("doc_id", F.lit(17))
    chosen = known.orderBy(mix, "doc_id").limit(rows)
    # Bounded by ``rows``: texts stay where they are.
    joined = only_columns(documents, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return statistics(joined).select(
        (F.col("quality") == 0).alias("bad"),
        F.pmod(F.xxhash64("doc_id", F.lit(29)), F.lit(3)).alias("fold"),
        *(F.expr(e).cast("double").alias(name) for name, e in FEATURES.items()),
    )


def binned(stats: DataFrame) -> tuple[DataFrame, dict[str, list[float]]]:
    """Each statistic as the number of cut points below it; cuts are its quantiles."""
    shares = [k / BINS for k in range(1, BINS)]
    found = stats.agg(
        *(F.percentile_approx(n, shares, 10_000).alias(n) for n in FEATURES)
    ).first()
    cuts = {n: sorted(set(found[n] or [])) for n in FEATURES}
    bins = [
        (sum(((F.col(n) > c).cast("int") for c in cuts[n]), F.lit(0))).alias(f"bin_{n}")
        for n in FEATURES
    ]
    return stats.select("bad", "fold", *bins), cuts


def histogram(rows: DataFrame) -> dict[str, dict[int, list[int]]]:
    """Rows by statistic, bin and label: at most statistics × bins × 2 numbers."""
    each = F.explode(
        F.array(*(F.struct(F.lit(n).alias("name"), F.col(f"bin_{n}").alias("bin")) for n in FEATURES))
    )
    counts: dict[str, dict[int, list[int]]] = {n: {} for n in FEATURES}
    found = rows.select("bad", each.alias("at")).groupBy("bad", "at.name", "at.bin").count()
    for bad, name, place, n in found.collect():
        counts[name].setdefault(place, [0, 0])[int(bad)] = n
    return counts


def best_condition(
    counts: dict[str, dict[int, list[int]]], cuts: dict[str, list[float]]
) -> tuple[float, Condition | None, tuple[int, int]]:
    """The threshold of the highest information gain for rejected rows."""
    best: tuple[float, Condition | None, tuple[int, int]] = (0.0, None, (0, 0))
    for name, by_bin in counts.items():
        good = sum(c[0] for c in by_bin.values())
        bad = sum(c[1] for c in by_bin.values())
        if not bad or not good:
            continue
        before = math.log2(bad / (bad + good))
        low = [0, 0]
        for place, cut in enumerate(cuts[name]):
            low = [low[k] + by_bin.get(place, [0, 0])[k] for k in (0, 1)]
            for above, (g, b) in ((False, low), (True, [good - low[0], bad - low[1]])):
                if b < MIN_COVERED:
                    continue
                gain = b * (math.log2(b / (b + g)) - before)
                if gain > best[0] + 1e-9:
                    best = (gain, Condition(name, above, cut, place), (g, b))
    return best


def together(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.on_bins()
    return out


def grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    rule: Rule = ()
    while len(rule) < MAX_CONDITIONS:
        _, condition, (good, _) = best_condition(histogram(rows.where(together(rule))), cuts)
        if condition is None:
            break
        rule += (condition,)
        if good == 0:
            break
    return rule


def prune(rows: DataFrame, rule: Rule) -> tuple[Rule, float, int]:
    """The shortest front part of the rule with the best value on rows it was not grown on."""
    sums = []
    for k in range(1, len(rule) + 1):
        hit = together(rule[:k])
        sums += [F.count_if(hit & F.col("bad")), F.count_if(hit & ~F.col("bad"))]
    found = list(rows.agg(*(s.alias(f"s{i}") for i, s in enumerate(sums))).first())
    best: tuple[Rule, float, int] = ((), 0.0, 0)
    for k in range(1, len(rule) + 1):
        bad, good = found[2 * k - 2], found[2 * k - 1]
        precision = (bad + 1) / (bad + good + 2)
        if bad and precision > best[1] + 1e-9:
            best = (rule[:k], precision, bad)
    return best


def learn_rules(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> list[Rule]:
    """An ordered list of rules that reject, learned from at most ``rows`` labelled rows."""
    stats = written(labelled_statistics(documents, labels, rows), "quality-labelled")
    data, cuts = binned(stats)
    data = written(data, "quality-bins")
    rules: list[Rule] = []
    left = data
    for _ in range(MAX_RULES):
        rule = grow(left.where("fold > 0"), cuts)
        if not rule:
            break
        rule, precision, covered = prune(left.where("fold = 0"), rule)
        if precision < MIN_PRECISION or covered < MIN_COVERED:
            break
        rules.append(rule)
        left = left.where(~together(rule))
    return rules


def verdict(rules: list[Rule]) -> Column:
    """One ordered expression over ``statistics``: the number of the rule that rejects, or null."""
    if not rules:
        return F.lit(None).cast("int")
    cases = " ".join(
        f"WHEN {' AND '.join(c.sql() for c in rule)} THEN {k}" for k, rule in enumerate(rules, 1)
    )
    return F.expr(f"CASE {cases} END").cast("int")


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def judge(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """``documents`` with statistics, ``base_failed``, ``rule`` and ``kept``."""
    rules = learn_rules(documents, labels, rows)
    judged = statistics(documents).withColumn("base_failed", base_failed())
    judged = judged.withColumn("rule", verdict(rules))
    return judged.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
