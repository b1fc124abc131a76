"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

A rule is a named condition that rejects a document. What a rule costs and how many
documents it rejects is estimated on a sample; the cascade then asks the rules in the
order of rejections per cost, and a document leaves at the first rule that rejects it.
The verdict is the same in any order; only the time differs.

Defined results: a null text counts as empty; a text without words has zero counts and
fails the base rules. Rows are judged one by one, so repeated rows and null ids stay as
they are. Columns named like a count are read from the text anew.
"""

import time
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import SPACES, text_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS = 400

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _words(body: Column) -> Column:
    """The words of a text; the white space around it goes first, as a cut would leave a gap."""
    trimmed = F.btrim(body, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[ \t-\r]+")
    )


def _repeat_words(words: Column) -> Column:
    """Hashes of the windows of three words, from one hash of each word."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    later = F.slice(hashes, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    last = F.slice(hashes, 3, F.greatest(F.size(words) - 2, F.lit(0)))
    triples = F.arrays_zip(
        F.slice(hashes, 1, F.size(last)).alias("a"),
        F.slice(later, 1, F.size(last)).alias("b"),
        last.alias("c"),
    )
    return F.transform(triples, lambda t: F.xxhash64(t["a"], t["b"], t["c"]))


def _covered(windows: Column) -> Column:
    """Size of the union of [p, p + 3) over the starts p of windows that occur again."""
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Neighbours in hash order hold the same window; one pass with the last two starts
    # marks both of an equal pair, and the distinct sorted starts remain.
    runs = F.zip_with(
        ordered,
        F.slice(ordered, 2, F.greatest(F.size(ordered) - 1, F.lit(0))),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
    )
    starts = F.array_sort(F.array_distinct(F.flatten(F.filter(runs, lambda x: x.isNotNull()))))
    return F.aggregate(
        starts,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("total")),
        lambda a, p: F.struct(
            p.alias("last"), (a["total"] + F.least(F.lit(3), p - a["last"])).alias("total")
        ),
        lambda a: a["total"],
    )


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words (all bigint)."""
    body = text_of(text)
    base = docs.drop(*_COUNTS).withColumn("_words", _words(body))
    lines = F.filter(F.split(body, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    base = base.withColumn("_lines", lines).withColumn("_windows", _repeat_words(F.col("_words")))
    # Most texts repeat no window; the branch that sorts is then not evaluated.
    repeated = F.when(
        F.size(F.array_distinct("_windows")) == F.size("_windows"), F.lit(0)
    ).otherwise(_covered(F.col("_windows")))
    counts = {
        "n_words": F.size("_words"),
        "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": repeated,
    }
    return base.withColumns({k: v.cast("bigint") for k, v in counts.items()}).drop(
        "_words", "_lines", "_windows"
    )


def base_failed() -> Column:
    """Too few words, or too many of them inside repeated windows."""
    return (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def default_rules(text: str = "text") -> dict[str, Column]:
    """Rules of the method: each is true for a document that it rejects.

    Ratios are per word or per character, so texts of every length are treated alike.
    """
    body = text_of(text)
    n_words = F.greatest(F.col("n_words"), F.lit(1))
    n_chars = F.greatest(F.col("word_chars"), F.lit(1))
    mean = F.col("word_chars") / n_words
    lines = F.greatest(F.size(F.split(body, "\n")), F.lit(1))
    shouts = F.length(body) - F.length(F.replace(body, F.lit("!"), F.lit("")))
    # Patterns that take whole runs and stay inside a line cost no more than the text's length.
    upper = F.length(F.regexp_replace(body, r"\P{Lu}+", ""))
    letters = F.length(F.regexp_replace(body, r"[^\p{L}\p{M}]+", ""))
    dots = F.regexp_count(body, F.lit(r"(?dm)(\.\.\.|…)[ \t\x0B\f\r]*$"))
    bullets = F.regexp_count(body, F.lit(r"(?dm)^[ \t\x0B\f\r]*[-*•]"))
    return {
        "word_length": (mean < 2) | (mean > 15),
        "symbols": F.col("n_symbols") > 0.1 * n_words,
        "repeated_lines": F.col("n_dup_lines") > 0.5 * lines,
        "exclamations": shouts > 0.1 * n_words,
        "capitals": upper > 0.4 * n_chars,
        "few_letters": letters < 0.6 * n_chars,
        "ellipses": dots > 0.3 * lines,
        "bullets": bullets > 0.9 * lines,
    }


def rank_rules(
    counted: DataFrame, rules: Mapping[str, Column], sample_rows: int = SAMPLE_ROWS
) -> list[tuple[str, float, float]]:
    """(rule, share rejected, seconds) on a sample, best rejection per second first.

    Only this order comes from the sample of ``sample_rows`` rows; every rule is still
    asked of every document that reaches it.
    """
    sample = counted.limit(sample_rows).cache()
    size = max(sample.count(), 1)
    measured = []
    for name, rule in rules.items():
        seconds = []
        for _ in range(2):
            began = time.perf_counter()
            hit = sample.where(rule).count()
            seconds.append(time.perf_counter() - began)
        measured.append((name, hit / size, max(min(seconds), 1e-6)))
    sample.unpersist()
    return sorted(measured, key=lambda m: (-m[1] / m[2], m[2], m[0]))


def cascade(rules: Mapping[str, Column], order: list[str]) -> Column:
    """Name of the first rule in ``order`` that rejects the row, or null.

    CASE evaluates its branches one after another and stops at the first that holds.
    """
    out = None
    for name in order:
        out = (F if out is None else out).when(rules[name], F.lit(name))
    return F.lit(None).cast("string") if out is None else out


def judge_quality(
    docs: DataFrame, rules: Mapping[str, Column] | None = None, text: str = "text"
) -> DataFrame:
    """All columns of ``docs`` with the five counts, base_failed, rejected_by and kept.

    A filter on the verdict stays above the counts: pushed below them, it would count the
    words of a text again at every mention, so the counts carry a column that pins it.

    ``rejected_by`` is the rule at which the cascade stopped; it depends on the measured
    order, ``kept`` does not.
    """
    rules = default_rules(text) if rules is None else rules
    counted = with_counts(docs, text)
    order = [name for name, _, _ in rank_rules(counted, rules)]
    pinned = counted.withColumn("_pin", F.spark_partition_id())
    judged = pinned.withColumn("base_failed", base_failed()).withColumn(
        "rejected_by", F.when(F.col("base_failed"), F.lit("base")).otherwise(cascade(rules, order))
    )
    kept = F.col("rejected_by").isNull() & (F.col("_pin") >= 0)
    return judged.withColumn("kept", kept).drop("_pin")
