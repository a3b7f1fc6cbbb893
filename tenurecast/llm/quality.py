"""Quality rules: word statistics, and decision lists learned from labelled statistics.

Everything per row is a Spark expression. The list is learned by sequential covering: a
rule is a conjunction of thresholds, grown on two thirds of the labelled rows by
information gain, pruned on the other third, kept if it is precise there and as many bad rows
would hardly be taken there by chance, and its rows removed before the next rule; the list
ends at the first rule that is not kept. The ordered rules become one ``CASE WHEN`` expression.

Null or empty texts have no words and fail the base test; ties in labels make no rule
precise and the texts stay; without labels the list is empty and only the base test acts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenurecast.llm.common import WORD_BREAK, table

# Characters of the symbol class and the white space class.
SYMBOL = "[#*$%&|<>]"
SPACE_CHARS = " \t\n\x0b\x0c\r"

#: Labelled rows the list is learned from at most: those whose keys hash lowest.
TRAINING_ROWS = 20_000
#: A rule must be right about this share of the rows it takes, and be right so often on the
#: rows held back that rows drawn at random would be so with at most this probability.
PRECISION, CHANCE = 0.95, 0.01


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def word_array(text: Column) -> Column:
    return F.filter(F.split(text, WORD_BREAK), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows found twice or more.

    Only texts where two window hashes are equal go on to find the places covered: by
    looking up a few repeated hashes, or else by sorting (hash, place) pairs, so the work
    is n log n at most.
    """

    def covered(hashes: Column) -> Column:
        def few(r: Column) -> Column:
            marked = F.transform(hashes, lambda h, i: F.when(F.array_contains(r, h), i))
            return F.filter(marked, lambda i: i.isNotNull())

        def many(p: Column) -> Column:
            n = F.size(p)
            twice = F.filter(
                p,
                lambda x, k: ((k > 0) & (F.get(p, k - 1)["h"] == x["h"]))
                | ((k < n - 1) & (F.get(p, k + 1)["h"] == x["h"])),
            )
            return F.sort_array(F.transform(twice, lambda x: x["i"]))

        def places(r: Column) -> Column:
            pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
            return F.when(F.size(r) <= 24, few(r)).otherwise(let(pairs, many))

        def twice(s: Column) -> Column:
            return F.array_distinct(F.filter(s, lambda x, k: (k > 0) & (F.get(s, k - 1) == x)))

        def total(at: Column) -> Column:
            n = F.size(at)
            gaps = F.transform(at, lambda x, k: F.when(k < n - 1, F.least(F.lit(3), F.get(at, k + 1) - x)).otherwise(3))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda s, g: s + g)

        return let(let(let(F.sort_array(hashes), twice), places), total)

    def count(hashes: Column) -> Column:
        same = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(same, covered(hashes)).otherwise(F.lit(0).cast("long"))

    def windows(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
        )
        return let(hashes, count)

    # A window twice needs four words.
    return F.when(F.size(words) >= 4, let(words, windows)).otherwise(F.lit(0).cast("long"))


def statistics(text: Column) -> Column:
    """One struct of counts for a text; a null text counts as one without words."""
    text = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            let(lines, F.size).cast("long").alias("n_lines"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_bang"),
        )

    return let(word_array(text), of)


def base_failed(s: Column) -> Column:
    return (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    """Numbers that rules may test, by name; all are shares, so long and short texts compare."""
    words = F.greatest(s["n_words"], F.lit(1)).cast("double")
    return {
        "symbols_per_word": s["n_symbols"] / words,
        "chars_per_word": s["word_chars"] / words,
        "repeat_share": s["n_repeat_words"] / words,
        "dup_line_share": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "bang_per_word": s["n_bang"] / words,
        "words_per_line": s["n_words"] / F.greatest(s["n_lines"], F.lit(1)),
    }


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    bound: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] > self.bound if self.above else x[self.feature] <= self.bound

    def column(self, x: dict[str, Column]) -> Column:
        return x[self.feature] > self.bound if self.above else x[self.feature] <= self.bound


Rule = tuple[Test, ...]


def _taken(rule: Rule, x: dict[str, np.ndarray], n: int) -> np.ndarray:
    taken = np.ones(n, bool)
    for test in rule:
        taken &= test.holds(x)
    return taken


def _best_test(x: dict[str, np.ndarray], bad: np.ndarray) -> Test | None:
    """The test with the highest gain of FOIL over the rows given."""
    p0, n0 = bad.sum(), len(bad)
    if not p0 or p0 == n0:
        return None
    before, best, found = np.log2(p0 / n0), 1e-9, None
    for name in sorted(x):
        order = np.argsort(x[name], kind="stable")
        v, b = x[name][order], np.cumsum(bad[order])
        cut = np.flatnonzero(v[1:] > v[:-1])
        if not len(cut):
            continue
        low_p, low_n = b[cut], cut + 1
        for above, p, n in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
            gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / n) - before), -1)
            k = int(gain.argmax())
            if gain[k] > best:
                best = float(gain[k])
                found = Test(name, above, float((v[cut[k]] + v[cut[k] + 1]) / 2))
    return found


def by_chance(k: int, n: int, share: float) -> float:
    """Probability that ``k`` or more of ``n`` rows are bad if each is with probability ``share``."""
    if not k or share >= 1:
        return 1.0
    if share <= 0:
        return 0.0
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    i = np.arange(k, n + 1)
    terms = logs[n] - logs[i] - logs[n - i] + i * np.log(share) + (n - i) * np.log1p(-share)
    return float(np.exp(terms).sum())


def cover(x: dict[str, np.ndarray], bad: np.ndarray) -> list[Rule]:
    """Learn ordered rules for the bad class; what no rule takes is good."""
    turn = np.arange(len(bad)) % 3 == 2
    left, rules = np.ones(len(bad), bool), []
    while bad[left].any():
        grow, prune = left & ~turn, left & turn
        gx = {k: v[grow] for k, v in x.items()}
        gb, rule, taken = bad[grow], [], np.ones(int(grow.sum()), bool)
        while taken.any() and not gb[taken].all():
            test = _best_test({k: v[taken] for k, v in gx.items()}, gb[taken])
            if test is None:
                break
            rule.append(test)
            taken &= test.holds(gx)
        if not rule:
            break
        px, pb = {k: v[prune] for k, v in x.items()}, bad[prune]

        def worth(r: Rule, px=px, pb=pb) -> float:
            t = _taken(r, px, len(pb))
            p, n = int((t & pb).sum()), int((t & ~pb).sum())
            return (p - n) / (p + n) if p + n else -1.0

        rule = tuple(rule)
        options = [rule[:k] for k in range(1, len(rule) + 1)]
        rule = max(options, key=lambda r: (worth(r), -len(r)))
        t = _taken(rule, x, len(bad)) & left
        held = t & turn
        if not held.any() or bad[held].mean() < PRECISION or bad[t].mean() < PRECISION:
            break
        if by_chance(int(bad[held].sum()), int(held.sum()), float(bad[left].mean())) > CHANCE:
            break
        rules.append(rule)
        left &= ~t
    return rules


def good(rules: list[Rule], x: dict[str, Column]) -> Column:
    """The ordered rules as one conditional expression: false where a rule takes the row."""
    verdict = None
    for rule in rules:
        test = rule[0].column(x)
        for more in rule[1:]:
            test = test & more.column(x)
        verdict = F.when(test, False) if verdict is None else verdict.when(test, False)
    return F.lit(True) if verdict is None else verdict.otherwise(True)


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> list[Rule]:
    """Rules from up to ``rows`` labelled texts that pass the base test.

    Rows are chosen by the hash of their key, so any order of the tables gives the same list.
    """
    marked = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    total = marked.count()
    if not total:
        return []
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    marked = marked.filter(unit < min(1.0, rows / total))
    with_stats = (
        docs.select("doc_id", "text")
        .join(marked, "doc_id")
        .select("doc_id", "quality", statistics(F.col("text")).alias("s"))
    )
    x = features(F.col("s"))
    marks = [F.col("doc_id"), F.col("quality"), *[v.alias(k) for k, v in x.items()]]
    # No filter on the statistics: Spark would push it down and compute them twice.
    got = with_stats.select(*marks, base_failed(F.col("s")).alias("failed")).collect()
    got = sorted((r for r in got if not r["failed"]), key=lambda r: tuple(r))
    got = [got[i] for i in np.random.default_rng(11).permutation(len(got))]
    values = {k: np.array([r[k] for r in got], float) for k in x}
    return cover(values, np.array([r["quality"] == 0 for r in got], bool))


def judged(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """All rows in one struct column ``row`` beside their statistics and both verdicts."""
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = out.withColumn("s", statistics(F.col("row")[text]))
    failed = base_failed(F.col("s"))
    return out.withColumns({"base_failed": failed, "kept": ~failed & good(rules, features(F.col("s")))})


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = learn(docs, table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged(docs, rules).select(
        F.col("row.doc_id").alias("doc_id"), *[F.col(f"s.{n}").alias(n) for n in names], "base_failed", "kept"
    )


def keep(docs: DataFrame, rules: list[Rule], text: str = "text") -> DataFrame:
    """The rows that pass, with their own columns.

    The row leaves through an array that is empty for rejected rows: a plain filter would be
    pushed below the statistics, which would then be computed twice.
    """
    marked = judged(docs, rules, text)
    return marked.select(F.inline(F.when(F.col("kept"), F.array("row"))))
