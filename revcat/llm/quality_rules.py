"""Quality rules: a decision list learned by sequential covering.

Features are Spark expressions over the whole text. A bounded sample of labelled
rows is reduced to counts per feature, bin, label and fold; from these counts a
rule grows condition by condition (information gain on the grow fold), is pruned
back on the other fold, and the rows it covers are set aside before the next rule
grows. What comes out is an ordered list of threshold conjunctions that reject, so
one ``CASE WHEN ... END`` decides about all rows. Every count is a Spark
aggregate; the driver only sees at most features x bins x 4 numbers per step.

Null or empty text has no words and fails the base rule. Without labels, or where
all labels agree, the list is empty and the base rule alone decides. Labels that
contradict each other for one document count as good. Repeated rows are judged
one by one; other columns are passed through and may have any name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revcat.llm.common import bind, whole_text, word_list
from revcat.session import written

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30  # per cent

#: Labelled rows that the rules are learned from, at most.
MAX_LABELLED = 20_000
BINS = 40
MAX_RULES, MAX_CONDITIONS = 8, 3
#: A rule is kept if so many of the rows it covers in the prune fold are bad, and it covers so many.
MIN_PRECISION, MIN_COVER = 0.75, 3

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What conditions may test, from the counts; all are free of the text's length.
RATIOS = {
    "symbols_per_word": "n_symbols / n_words",
    "mean_word_chars": "word_chars / n_words",
    "repeated_share": "n_repeat_words / n_words",
    "duplicate_line_share": "n_dup_lines / n_lines",
    "upper_share": "n_upper / word_chars",
    "marks_per_word": "n_marks / n_words",
    "words_per_line": "n_words / n_lines",
}


def _count_of(text: Column, characters: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{characters}]")).cast("long")


def _repeated_words(words: Column) -> Column:
    """Words in windows of WINDOW words that occur at least twice in ``words``."""
    # The hash of a window is built by doubling: words, pairs, fours, eights.
    def doubled(step: int):
        def pairs(h: Column) -> Column:
            rest = F.size(h) - step
            return F.zip_with(F.slice(h, F.lit(1), rest), F.slice(h, F.lit(step + 1), rest), lambda a, b: F.xxhash64(a, b))

        return pairs

    windows = F.array(F.transform(words, lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        windows = F.transform(windows, doubled(step))
    windows = F.get(windows, 0)

    def covered(marked: Column) -> Column:
        # (start, hash) in the order of the hash: a repeat has an equal neighbour.
        ordered = F.array(F.array_sort(F.transform(marked, lambda h, i: F.struct(h.alias("h"), i.alias("i")))))

        def starts(pairs: Column) -> Column:
            def repeated(p, j):
                before = (j > 0) & (F.get(pairs, j - 1)["h"] == p["h"])
                return before | F.coalesce(F.get(pairs, j + 1)["h"] == p["h"], F.lit(False))

            return F.array_sort(F.transform(F.filter(pairs, repeated), lambda p: p["i"]))

        found = F.get(F.transform(ordered, starts), 0)
        state = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
        return F.aggregate(
            found, state,
            lambda s, i: F.struct(
                (s["n"] + i + WINDOW - F.greatest(s["end"], i)).cast("long").alias("n"), (i + WINDOW).alias("end")
            ),
            lambda s: s["n"],
        )

    # Most texts repeat nothing, which the number of distinct windows tells without a sort.
    counted = F.get(
        F.transform(F.array(windows), lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(covered(w))), 0
    )
    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(counted)


def with_features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one more column ``quality_``, a struct of all features."""
    text = whole_text(text_col)
    bound = bind(docs, words_=word_list(text), lines_=F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    words, lines = F.col("words_"), F.col("lines_")
    counts = bind(
        bound,
        counts_=F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _count_of(text, SYMBOLS).alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeated_words(words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            _count_of(text, "A-Z").alias("n_upper"),
            _count_of(text, "!?").alias("n_marks"),
        ),
    )
    ratios = [F.coalesce(_ratio(e), F.lit(0.0)).alias(n) for n, e in RATIOS.items()]
    failed = _failed(F.col("counts_.n_words"), F.col("counts_.n_repeat_words"))
    quality = F.struct(*[F.col(f"counts_.{c}").alias(c) for c in BASE], *ratios, failed.alias("base_failed"))
    return bind(counts, quality_=quality).drop("words_", "lines_", "counts_")


def _ratio(text: str) -> Column:
    above, below = text.split(" / ")
    return F.col(f"counts_.{above}") / F.when(F.col(f"counts_.{below}") > 0, F.col(f"counts_.{below}"))


def _failed(n_words: Column, n_repeated: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeated > MAX_REPEATED * n_words)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(f"quality_.{self.feature}")
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def rejects(rules: list[Rule]) -> Column:
    """The number of the first rule that fits, in order; null if none does."""
    chosen = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        fits = F.lit(True)
        for condition in rule:
            fits &= condition.column()
        chosen = F.when(fits, F.lit(number)).otherwise(chosen)
    return chosen


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Features, bad (0/1) and fold of at most MAX_LABELLED rows, chosen by a hash of the identifier."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    order = F.xxhash64(F.lit("quality"), F.col("doc_id"))
    sample = known.orderBy(order, "doc_id").limit(MAX_LABELLED)
    bad = (F.col("quality") == 0).cast("int")
    sample = sample.select(F.col("doc_id").alias("labelled_id"), bad.alias("bad"), F.pmod(F.shiftright(order, 7), F.lit(3)).alias("third"))
    one = docs.select(F.col(id_col).cast("long").alias("labelled_id"), F.col(text_col).alias("text"))
    # The sample is bounded by MAX_LABELLED rows of 16 bytes.
    rows = with_features(one.join(F.broadcast(sample), "labelled_id"))
    return rows.select("quality_", "bad", (F.col("third") == 0).alias("prune")).where("NOT quality_.base_failed")


def _bin(feature: str, cuts: list[float]) -> Column:
    """The feature's name and how many of its cuts the value reaches."""
    value = F.col(f"quality_.{feature}")
    reached = F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= value)
    return F.struct(F.lit(feature).alias("feature"), F.size(reached).alias("bin"))


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[Rule]:
    """Rules that reject, learned from the labels (doc_id, quality) of these documents."""
    rows = written(_labelled(docs, labels, id_col, text_col), "quality")
    probabilities = [i / BINS for i in range(1, BINS)]
    cuts: dict[str, list[float]] = {f: [] for f in RATIOS}
    for some in (rows, rows.where("bad = 1")):  # where all rows lie, and where the rare bad ones do
        at = some.agg(*[F.percentile_approx(f"quality_.{f}", probabilities, 10_000).alias(f) for f in RATIOS]).first()
        cuts = {f: sorted({*cuts[f], *(at[f] or [])}) for f in RATIOS}
    bins = [_bin(f, cuts[f]) for f in RATIOS if cuts[f]]
    if not bins:
        return []

    def counts(rule: Rule, rules: list[Rule]) -> dict[tuple[str, bool], list[list[int]]]:
        """For each feature and fold: [good, bad] by bin, of the rows the rule fits and no earlier rule does."""
        left = rows.where(rejects(rules).isNull())
        if rule:
            left = left.where(rejects([rule]).isNotNull())
        each = left.select("bad", "prune", F.explode(F.array(*bins)).alias("b")).groupBy("b.feature", "b.bin", "prune", "bad").count()
        found = {(f, prune): [[0, 0] for _ in range(len(cuts[f]) + 1)] for f in RATIOS for prune in (False, True)}
        for r in each.collect():
            found[r["feature"], r["prune"]][r["bin"]][r["bad"]] += r["count"]
        return found

    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        rule, steps = (), []
        at = counts((), rules)
        while len(rule) < MAX_CONDITIONS:
            condition = _best(at, cuts)
            if condition is None:
                break
            rule += (condition,)
            at = counts(rule, rules)
            good, bad = (sum(x[k] for x in at[condition.feature, True]) for k in (0, 1))
            steps.append((good, bad))
            if not sum(x[0] for x in at[condition.feature, False]):
                break
        # Prune: the shortest prefix that does best on rows the rule was not grown on.
        worth = [((bad - good) / (bad + good) if bad + good else -1.0) for good, bad in steps]
        if not steps:
            break
        best = max(range(len(steps)), key=lambda i: (worth[i], -i))
        good, bad = steps[best]
        if bad < MIN_COVER or bad < MIN_PRECISION * (good + bad):
            break
        rules.append(rule[: best + 1])
    return rules


def _best(at: dict, cuts: dict) -> Condition | None:
    """The condition with the largest information gain on the grow fold."""
    best, most = None, 1e-9
    for feature, thresholds in cuts.items():
        if not thresholds:
            continue
        bins = at[feature, False]
        good, bad = sum(b[0] for b in bins), sum(b[1] for b in bins)
        if not bad:
            continue
        base = math.log2(bad / (good + bad))
        g, b = 0, 0
        for k, threshold in enumerate(thresholds):
            g, b = g + bins[k][0], b + bins[k][1]
            for above, (p, n) in ((False, (b, g)), (True, (bad - b, good - g))):
                gain = p * (math.log2(p / (p + n)) - base) if p else 0.0
                if gain > most:
                    best, most = Condition(feature, above, float(threshold)), gain
    return best


def judge(docs: DataFrame, rules: list[Rule], text_col: str = "text") -> DataFrame:
    """``docs`` with ``quality_`` (features and base_failed), ``rule_`` (first that fits) and ``kept_``.

    Only these three names may not be among the columns of ``docs``.
    """
    if taken := {"quality_", "rule_", "kept_"} & {c.lower() for c in docs.columns}:
        raise ValueError(f"columns have names of the result: {sorted(taken)}")
    return _judged(docs, rules, text_col).select("row.*", "quality_", "rule_", "kept_")


def _judged(docs: DataFrame, rules: list[Rule], text_col: str) -> DataFrame:
    """``row`` (all columns, which may have any name, as a struct), quality_, rule_ and kept_."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), whole_text(f"`{text_col}`").alias("text"))
    judged = bind(with_features(packed), rule_=rejects(rules))
    return judged.withColumn("kept_", ~F.col("quality_.base_failed") & F.col("rule_").isNull())


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the base rule and the learned rules keep, with their own columns, whatever their names."""
    return _judged(docs, learn(docs, labels, id_col, text_col), text_col).where("kept_").select("row.*")
