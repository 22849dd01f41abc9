"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a predicate on a text ("this text fails"). On a sample the
cascade measures each rule's cost (seconds to evaluate it) and selectivity
(share of the sample that fails it), then evaluates the rules in the order of
rejection per cost inside one CASE: a text that a cheap, selective rule has
rejected never reaches the dear ones. The order changes the time and the
reported first failing rule, never which texts are kept.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, quoted, staged, unused

#: White space that separates words.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: Rows, about, of the even sample that the order of the rules is estimated on.
SAMPLE_ROWS = 400


def words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.char_length(F.translate(text, SPACE_CHARS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long")


def full_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")


def n_dup_lines(text: Column) -> Column:
    return let(full_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def n_repeat_words(text: Column, window: int = WINDOW) -> Column:
    """Words inside ``window``-word windows that occur twice or more in the text.

    Window hashes (64 bits) are compared; texts without an equal pair stop
    there. The others sort (hash, place), mark places with an equal neighbour
    and add up what the marked windows cover: n log n in the text's words.
    """
    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(pairs, lambda s: F.aggregate(
            F.array_sort(F.transform(F.filter(F.zip_with(
                F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.struct(
                    a["i"].alias("i"), F.coalesce(a["h"] == b["h"], F.lit(False)).alias("up"), a["h"].alias("h"))),
                F.concat(F.slice(s, 1, 1), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0)))),
                lambda a, b: F.struct(a["i"].alias("i"), (a["up"] | ((a["h"] == b["h"]) & (a["i"] != b["i"]))).alias("twice"))),
                lambda e: e["twice"]), lambda e: e["i"])),
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda a, p: F.struct((p + window).alias("end"), (a["n"] + p + window - F.greatest(p, a["end"])).alias("n")),
            lambda a: a["n"]))

    def of(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(w) - (window - 1))
        return F.when(F.size(w) <= window, F.lit(0)).otherwise(let(
            F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, window))),
            lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))

    return let(words(text), of).cast("long")


METRICS: dict[str, Callable[[Column], Column]] = {
    "n_words": n_words, "word_chars": word_chars, "n_symbols": n_symbols,
    "n_dup_lines": n_dup_lines, "n_repeat_words": n_repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """``fails(metric)`` is the predicate; ``metric(name)`` gives a metric's column."""

    name: str
    fails: Callable[[Callable[[str], Column]], Column]


RULES = [
    Rule("few_words", lambda m: m("n_words") < 20),
    Rule("repeated_words", lambda m: 100 * m("n_repeat_words") > 30 * m("n_words")),
    Rule("symbols", lambda m: 10 * m("n_symbols") > 3 * m("n_words")),
    Rule("repeated_lines", lambda m: 100 * m("n_dup_lines") > 50 * m("n_lines")),
    Rule("word_length", lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 20 * m("n_words"))),
]
BASE = ("few_words", "repeated_words")
#: Metrics that the digest returns; others are only evaluated where the cascade asks for them.
RETURNED = tuple(METRICS)
METRICS["n_lines"] = lambda text: F.size(full_lines(text)).cast("long")


def rule_order(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text",
               sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of ``rules`` by rejection per cost, measured on an even sample of about ``sample_rows`` rows.

    Cost is the time of evaluating the rule over the sample beyond that of a
    constant; selectivity is its failing share. Both only set the order. The
    sample stays in the cluster's shared folder; the driver gets the counts.
    """
    share = min(1.0, sample_rows / max(1, docs.count()))
    sample = staged(docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).sample(share, 11).repartition(4), "rules-sample")

    def run(predicate: Column) -> tuple[float, int]:
        began = time.perf_counter()
        row = sample.agg(F.count(F.when(predicate, 1)).alias("n")).first()
        return time.perf_counter() - began, row["n"]

    def metric(name: str) -> Column:
        return METRICS[name](F.col("text"))

    run(F.char_length("text") < 0)
    idle, _ = run(F.char_length("text") < 0)
    score = {}
    for rule in rules:
        took, failed = run(rule.fails(metric))
        score[rule.name] = (failed + 0.5) / max(took - idle, 1e-3)
    return sorted(score, key=lambda name: (-score[name], name))


def first_failure(metric: Callable[[str], Column], order: list[str], rules: list[Rule] = RULES) -> Column:
    """Name of the first rule of ``order`` that the text fails, else null; later rules aren't evaluated."""
    by_name = {r.name: r for r in rules}
    out = None
    for name in order:
        fails = by_name[name].fails(metric)
        out = F.when(fails, name) if out is None else out.when(fails, name)
    return F.lit(None).cast("string") if out is None else out.otherwise(F.lit(None).cast("string"))


def cascade(docs: DataFrame, rules: list[Rule] = RULES, text_col: str = "text",
            out_col: str = "failed_rule", order: list[str] | None = None, counted: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with ``out_col``: the first failed rule, or null for kept rows.

    A null text counts as empty (it fails ``few_words``). No shuffle; metrics
    are evaluated inside the CASE, only for texts that came that far; those
    ``counted`` are columns of ``docs`` already.
    """
    order = rule_order(docs, rules, text_col) if order is None else order
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn(out_col, first_failure(
        lambda name: F.col(name) if name in counted else METRICS[name](text), order, rules))


def keep_passing(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Rows of ``docs``, all columns, whose text fails no rule. A null or empty text fails ``few_words``; repeated rows all stay."""
    failed, = unused(docs.columns, "failed_rule")
    return cascade(docs, rules, out_col=failed).where(F.col(failed).isNull()).select(*quoted(docs.columns))


def quality_digest(docs: DataFrame) -> DataFrame:
    """Every document's base metrics, whether a base rule fails, and the cascade's verdict.

    A null text counts as empty; repeated rows and null ids each give a row; an
    empty table gives none. Other columns are not read.
    """
    order = rule_order(docs)
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select("doc_id", "text", *(METRICS[m](text).alias(m) for m in RETURNED))
    base = first_failure(F.col, [n for n in order if n in BASE])
    return cascade(counted, order=order, counted=RETURNED).select(
        "doc_id", *RETURNED, base.isNotNull().alias("base_failed"), F.col("failed_rule").isNull().alias("kept"), "failed_rule")
