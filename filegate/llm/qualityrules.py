"""Quality rules with risk-controlled thresholds (DataFrame functions only).

Every text is measured once, inside its row. A rule rejects a document whose measure lies beyond
the rule's cutoff. Cutoffs are chosen per stratum (the language here) on the labelled documents as a holdout:

* a rule's candidates are a fixed list from lenient to strict, given before any label is read;
* of the stratum's ``n`` good holdout documents, a cutoff rejects ``k``. ``P(Bin(n, a) <= k)`` is the exact
  p-value of "the cutoff rejects more than the share ``a`` of good documents";
* candidates are tested in their order until the first one fails (fixed-sequence testing: no
  correction is due within a list), at the level ``delta / (strata * rules)`` (Bonferroni over the lists);
* ``a`` is ``risk / rules``, so all rules together reject more than ``risk`` of the good documents of any
  stratum with probability ``delta`` at most. A stratum with too few labels gets no cutoff, and keeps all.

Bounded by construction: the holdout is reduced to counts per (stratum, rule, candidate); the cutoffs are one
row per stratum, broadcast behind a check of their number and joined otherwise. No row is dropped or
sampled; words and windows of a text stay in its row, so a task is bounded by its longest text.

Rows, one for each input row: a null text has no words (``base_failed``); a null stratum is a stratum of
its own; a null id is never labelled; an id on several rows is one holdout document (the smallest measures), an id
with several labels is good only if all say so; labels without id or label are left out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from filegate.llm.staging import by_name, stage

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
#: Base rules: fewer words than this, or more than this percentage of words in repeated windows.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: Share of good documents that may be rejected in a stratum, and the probability that it is exceeded.
RISK, DELTA = 0.05, 0.05
#: Strata whose cutoffs are broadcast (some 100 bytes each); beyond, they are joined.
BROADCAST_STRATA = 50_000
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Reject where ``measure`` is above the cutoff; ``cutoffs`` run from lenient to strict."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]


def _share(part: str, whole: str) -> str:
    return f"coalesce({part} / nullif({whole}, 0), 0.0D)"


RULES = (
    Rule("symbols", _share("n_symbols", "word_chars"), (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.02)),
    Rule("dup_lines", _share("n_dup_lines", "n_lines"), (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("repeats", _share("n_repeat_words", "n_words"), (0.48, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.05)),
    Rule("long_words", _share("word_chars", "n_words"), (40.0, 30.0, 25.0, 20.0, 15.0, 12.0, 10.0, 9.0, 8.0)),
)


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that stand in the text at least twice.

    Window hashes are sorted with their positions; equal neighbours are compared by their words. Only texts with a
    repeated hash are sorted.
    """
    hashes = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def same(a: Column, b: Column) -> Column:
        def equal(d):
            return F.get(words, a["i"] + d) == F.get(words, b["i"] + d)

        return (a["h"] == b["h"]) & equal(0) & equal(1) & equal(2)

    def covered(sorted_windows: Column) -> Column:
        def repeated(w, k):
            before, after = F.get(sorted_windows, k - 1), F.get(sorted_windows, k + 1)
            return F.coalesce(same(w, before), F.lit(False)) | F.coalesce(same(w, after), F.lit(False))

        hits = F.sort_array(F.transform(F.filter(sorted_windows, repeated), lambda w: w["i"]))
        return _bind(hits, lambda p: F.aggregate(
            F.transform(p, lambda at, k: F.coalesce(F.least(F.lit(3), F.get(p, k + 1) - at), F.lit(3))),
            F.lit(0).cast("long"), lambda total, x: total + x))

    def count(h: Column) -> Column:
        windows = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) < F.size(h), _bind(windows, covered)).otherwise(F.lit(0).cast("long"))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_bind(hashes, count))


def measures(text: Column) -> Column:
    """The counts of ``COUNTS`` as a struct, for a text that is not null."""
    words = F.array_remove(F.split(text, BLANKS), "")
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of_words(w: Column) -> Column:
        return _bind(lines, lambda x: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words")))

    return _bind(words, of_words)


def binomial_tail(n: Column, k: Column, share: float) -> Column:
    """``P(Bin(n, share) <= k)`` exactly: the sum of the ``k + 1`` terms, each from the one before, in logarithms.

    Where ``k`` exceeds ``n * share`` the tail is about a half or more and no level accepts it: 1 is returned.
    """
    log_odds = F.lit(share / (1 - share))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] + F.log((n - j + 1) / j * log_odds)
        top = F.greatest(state["total"], term)
        total = top + F.log(F.exp(state["total"] - top) + F.exp(term - top))
        return F.struct(term.alias("term"), total.alias("total"))

    first = n * F.log1p(F.lit(-share))
    start = F.struct(first.alias("term"), first.alias("total"))
    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    tail = F.aggregate(steps, start, add, lambda state: F.exp(state["total"]))
    return F.when(k > n * share, F.lit(1.0)).otherwise(tail)


def _stratum(column: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), column.cast("string")), F.lit("n"))


def _base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def measured(docs: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, stratum``, the counts, ``base_failed`` and one measure per rule, for every row."""
    text = F.coalesce(by_name(text_col).cast("string"), F.lit(""))
    rows = docs.select(by_name(id_col).alias("id"), _stratum(by_name(stratum_col)).alias("stratum"),
                       measures(text).alias("m"))
    rows = rows.select("id", "stratum", "m.*")
    return rows.select("*", _base_failed().alias("base_failed"),
                       *[F.expr(r.measure).alias(f"measure_{r.name}") for r in RULES])


def _rejecting(rule: Rule) -> Column:
    """How many candidates of the rule reject a document: the last ones of its list."""
    return F.size(F.filter(F.array(*map(F.lit, rule.cutoffs)), lambda c: F.col(f"measure_{rule.name}") > c))


def holdout_counts(rows: DataFrame, labels: DataFrame, label_col: str = "quality",
                   label_id: str = "doc_id") -> DataFrame:
    """``stratum, rule, step, n, k``: good labelled documents, and those the rule's candidate ``step`` rejects.

    Good documents that the base rules reject are none of the method's rejections and stay out.
    """
    good = (labels.where(by_name(label_id).isNotNull() & by_name(label_col).isNotNull())
            .groupBy(by_name(label_id).alias("id")).agg((F.min(by_name(label_col)) > 0).alias("good"))
            .where("good").select("id"))
    steps = [_rejecting(r).alias(r.name) for r in RULES]
    fields = ["stratum", "base_failed", *[f"measure_{r.name}" for r in RULES]]
    one = rows.where("id is not null").groupBy("id").agg(F.min(F.struct(*fields)).alias("m"))
    held = one.join(good, "id", "left_semi").select("m.*").where("not base_failed").select("stratum", *steps)
    long = held.select("stratum", F.explode(F.array(
        *[F.struct(F.lit(r.name).alias("rule"), F.col(r.name).alias("hit")) for r in RULES])).alias("x"))
    hits = long.groupBy("stratum", "x.rule", "x.hit").agg(F.count(F.lit(1)).alias("rows"))
    # one row per (stratum, rule) with the counts by number of rejecting candidates, then one per candidate
    per = hits.groupBy("stratum", "rule").agg(
        F.sum("rows").alias("n"), F.collect_list(F.struct("hit", "rows")).alias("by_hit"))
    size = F.coalesce(*[F.when(F.col("rule") == r.name, F.lit(len(r.cutoffs))) for r in RULES])
    cand = per.select("stratum", "rule", "n", "by_hit", size.alias("size"), F.explode(
        F.sequence(F.lit(1), size)).alias("step"))
    # candidates are nested: number ``step`` rejects whatever at least ``size - step + 1`` of them reject
    k = F.aggregate(F.filter("by_hit", lambda x: x["hit"] > F.col("size") - F.col("step")), F.lit(0).cast("long"),
                    lambda total, x: total + x["rows"])
    return cand.select("stratum", "rule", "step", "n", k.alias("k"))


def choose_cutoffs(counts: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """``stratum, rule, step, cutoff``: the strictest candidate before the first that fails its test."""
    counts = stage(counts, "quality-counts")
    strata = counts.select("stratum").distinct().count()
    tested = counts.withColumn("p", binomial_tail(F.col("n"), F.col("k"), risk / len(RULES)))
    in_order = Window.partitionBy("stratum", "rule").orderBy("step")
    worst = F.max("p").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    passed = tested.withColumn("worst", worst).where(F.col("worst") <= delta / max(1, strata * len(RULES)))
    best = passed.groupBy("stratum", "rule").agg(F.max("step").alias("step"))
    value = F.coalesce(*[F.when(F.col("rule") == r.name, F.get(F.array(*map(F.lit, r.cutoffs)), F.col("step") - 1))
                         for r in RULES])
    return best.select("stratum", "rule", "step", value.alias("cutoff"))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum_col: str = "lang", id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "quality", risk: float = RISK,
                  delta: float = DELTA) -> DataFrame:
    """Every row's id, counts, ``base_failed``, ``kept`` and ``failed_rules`` (names, in the order of ``RULES``)."""
    spark = docs.sparkSession
    rows = stage(measured(docs, stratum_col, id_col, text_col), "quality-measures")
    cutoffs = choose_cutoffs(holdout_counts(rows, labels, label_col, id_col), risk, delta)
    wide = stage(cutoffs.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"cutoff_{r.name}") for r in RULES]),
        "quality-cutoffs")
    side = F.broadcast(wide) if wide.count() <= BROADCAST_STRATA else wide
    failed = F.array_compact(F.array(*[
        F.when(F.col(f"measure_{r.name}") > F.col(f"cutoff_{r.name}"), F.lit(r.name)) for r in RULES]))
    judged = rows.join(side, "stratum", "left").select(
        F.col("id").alias(id_col), *[c for c in COUNTS if c != "n_lines"], "base_failed",
        failed.alias("failed_rules"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).select(
        *judged.columns[:-1], "kept", F.array_join("failed_rules", ",").alias("failed_rules"))
