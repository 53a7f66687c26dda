"""Quality rules as a learned decision list, in DataFrame expressions only.

Text statistics are SQL expressions over each whole text. Sequential covering then learns an ordered list of
threshold conjunctions for low-quality rows from labelled statistics: each rule is grown on two thirds of the
labelled rows by FOIL gain, pruned on the rest, kept while it is precise, and the rows it covers are set aside.
The counts that grow a rule are one Spark aggregation (feature x bin x label), so the driver sees a few hundred
numbers whatever the number of labelled rows. The list is emitted as one ordered conditional expression.

Defined cases: a null or empty text has no words, zero statistics and fails the base rule; labels that are null are
not used; without labels (or without a precise rule) only the base rule decides; repeated rows are judged each; other
columns are neither read nor changed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from culvert.llm.common import stored, table

#: Cut points per feature (quantiles of the labelled rows).
CUTS = 24
MAX_RULES = 12
MAX_CONDITIONS = 3
#: A rule must be this precise on the rows that pruned it, and catch so many there.
MIN_PRECISION = 0.95
MIN_CAUGHT = 3

_SPACE = " \t\n\x0b\f\r"


def _let(value: Column, body) -> Column:
    """Bind ``value`` once: inside ``body`` it is a variable, so it is not evaluated again for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more, first occurrence included."""
    n = F.size(words)

    def covered(pos: Column) -> Column:
        steps = F.zip_with(F.slice(pos, 2, F.size(pos) - 1), F.slice(pos, 1, F.size(pos) - 1), lambda b, a: F.least(b - a, F.lit(3)))
        return F.lit(3) + F.aggregate(steps, F.lit(0), lambda t, x: t + x)

    def repeated(s: Column) -> Column:
        same = lambda x, i, j: (j >= 0) & (j < F.size(s)) & (F.get(s, j)["h"] == x["h"])
        hit = F.filter(s, lambda x, i: same(x, i, i - 1) | same(x, i, i + 1))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def of(grams: Column) -> Column:
        indexed = F.array_sort(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        slow = _let(indexed, lambda s: _let(repeated(s), covered))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(slow)

    grams = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n < 3, F.lit(0)).otherwise(_let(grams, of)).cast("long")


def statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key and the statistics of each whole text; the base columns are longs, the learned features doubles."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    t = F.col("t")
    size = F.length(t)
    without = lambda chars: F.length(F.translate(t, chars, ""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.btrim(x, F.lit(_SPACE))) > 0)
    per_words = _let(_words(t), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.size(F.array_distinct(w)).cast("double").alias("n_distinct"), _repeat_words(w).alias("n_repeat_words")))
    per_lines = _let(lines, lambda x: F.struct(F.size(x).cast("double").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    raw = rows.select(
        "doc_id", per_words.alias("w"), per_lines.alias("l"), size.cast("long").alias("chars"), without(_SPACE).cast("long").alias("word_chars"),
        (size - without("#*$%&|<>")).cast("long").alias("n_symbols"), (size - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("upper"),
        (size - without("0123456789")).alias("digits"), (size - without("!?")).alias("marks"), (size - without(".,;:")).alias("stops"), (size - without("|/\\_{}[]=~^@")).alias("odd"),
    )
    share = lambda a, b: F.col(a).cast("double") / F.greatest(F.col(b).cast("double"), F.lit(1.0))
    return raw.select(
        "doc_id", F.col("w.n_words").alias("n_words"), "word_chars", "n_symbols", F.col("l.n_dup_lines").alias("n_dup_lines"), F.col("w.n_repeat_words").alias("n_repeat_words"),
        F.col("w.n_words").cast("double").alias("f_words"), share("word_chars", "w.n_words").alias("f_word_length"), share("n_symbols", "word_chars").alias("f_symbols"),
        share("l.n_dup_lines", "l.n_lines").alias("f_dup_lines"), share("w.n_repeat_words", "w.n_words").alias("f_repeats"), share("w.n_distinct", "w.n_words").alias("f_distinct"),
        share("upper", "word_chars").alias("f_upper"), share("digits", "word_chars").alias("f_digits"), share("marks", "word_chars").alias("f_marks"),
        share("stops", "w.n_words").alias("f_stops"), share("odd", "word_chars").alias("f_odd"), share("w.n_words", "l.n_lines").alias("f_line_words"),
    )


FEATURES = ("f_words", "f_word_length", "f_symbols", "f_dup_lines", "f_repeats", "f_distinct", "f_upper", "f_digits", "f_marks", "f_stops", "f_odd", "f_line_words")

Condition = tuple[str, str, float]


def _holds(rule: list[Condition]) -> Column:
    out = F.lit(True)
    for f, op, cut in rule:
        out = out & ((F.col(f) > F.lit(cut)) if op == ">" else (F.col(f) <= F.lit(cut)))
    return out


def learn(labelled: DataFrame, bad: str = "bad") -> list[list[Condition]]:
    """Rules for rows with ``bad`` = 1, by sequential covering; ``labelled`` has the features, ``bad`` and ``doc_id``."""
    cuts_row = labelled.agg(*[F.percentile_approx(f, [i / (CUTS + 1) for i in range(1, CUTS + 1)], 10000).alias(f) for f in FEATURES]).first()
    if cuts_row is None or cuts_row[0] is None:
        return []
    cuts = {f: sorted(set(cuts_row[f])) for f in FEATURES}

    def cell(f: str) -> Column:
        """The number of cut points below the feature's value."""
        return F.size(F.filter(F.array(*map(F.lit, cuts[f])), lambda c: F.col(f) > c))

    cells = F.array(*[F.struct(F.lit(i).alias("f"), cell(f).alias("b")) for i, f in enumerate(FEATURES)])
    rows = stored(labelled.select("*", cells.alias("cells"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prunes")), "rules")
    rules: list[list[Condition]] = []

    def counts(data: DataFrame, rule: list[Condition]) -> tuple[int, int]:
        r = data.where(_holds(rule)).agg(F.sum(bad), F.count("*")).first()
        return int(r[0] or 0), int(r[1]) - int(r[0] or 0)

    def grow(data: DataFrame) -> list[Condition]:
        rule: list[Condition] = []
        p0, n0 = counts(data, rule)
        while len(rule) < MAX_CONDITIONS and p0 and n0:
            got = data.where(_holds(rule)).select(F.explode("cells").alias("c"), bad).groupBy("c.f", "c.b").agg(F.sum(bad).alias("p"), F.count("*").alias("n")).collect()
            best, best_gain, best_pn = None, 0.0, (0, 0)
            for i, f in enumerate(FEATURES):
                cell = {r["b"]: (r["p"], r["n"] - r["p"]) for r in got if r["f"] == i}
                for j, cut in enumerate(cuts[f]):
                    low = tuple(sum(v[k] for b, v in cell.items() if b <= j) for k in (0, 1))
                    for op, (p, n) in (("<=", low), (">", (p0 - low[0], n0 - low[1]))):
                        if p and p + n < p0 + n0:
                            gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))
                            if gain > best_gain * (1 + 1e-9):
                                best, best_gain, best_pn = (f, op, cut), gain, (p, n)
            if best is None:
                break
            rule.append(best)
            p0, n0 = best_pn
        return rule

    while len(rules) < MAX_RULES:
        left = rows
        for r in rules:
            left = left.where(~_holds(r))
        rule = grow(left.where(~F.col("prunes")))
        if not rule:
            break
        pruning = left.where("prunes")
        tried = [(rule[:k], *counts(pruning, rule[:k])) for k in range(1, len(rule) + 1)]
        rule, p, n = max(tried, key=lambda x: ((x[1] - x[2]) / max(1, x[1] + x[2]), len(x[0]) * -1))
        if p < MIN_CAUGHT or p / (p + n) < MIN_PRECISION:
            break
        rules.append(rule)
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The list as one ordered conditional: the number (from 1) of the first rule that holds, else null."""
    out = F.lit(None).cast("int")
    for i, r in reversed(list(enumerate(rules, 1))):
        out = F.when(_holds(r), F.lit(i)).otherwise(out)
    return out


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics of every row with ``base_failed``, ``rule`` (of the list, or null) and ``kept``."""
    stats = stored(statistics(docs), "quality")
    given = labels.where(F.col("quality").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    rules = learn(stats.join(given, "doc_id"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules)).withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = judged(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")
