"""URL filter: domain rules first, then naive Bayes over segmented hosts and paths.

Host names are often words written together. Words and their counts come from the titles of
all pages, the tokens of all paths and the parts that several hosts share; a unigram Viterbi search splits every part of a host
into the words of greatest joint probability. A multinomial naive Bayes model over host
words, path words and (marked) whole host parts learns from the urls that the rules decide
and judges the others.

Distinct hosts are segmented once: their substrings are joined to the word counts, so the
vocabulary is neither cut nor broadcast. The Bayes model counts hashed tokens in a table of
fixed size, which is what goes to the executors.

Defined results: a null url, or one without ``://``, has empty host and path and is judged by
the method on no tokens, that is by the prior. Ties go to ``allow``. Repeated rows stay; a null id is an id like any other. Only the id, url and html
columns are used. Without any url that a rule decides, the prior is even.
"""

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.llm.common import stored

BITS = 18
LONGEST = 20
PARTS = r"[.\-_:]"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"


RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A to Z lowered."""
    return F.translate(
        F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1),
        _UPPER,
        _UPPER.lower(),
    )


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = (F if found is None else found).when(fits, value)
    return found


def word_counts(
    pages: DataFrame, hosts: DataFrame, url: str = "url", html: str | None = "html"
) -> DataFrame:
    """(word, count) over the tokens of all paths, all titles if there is html, and host parts.

    A part counts once for every distinct host that has it, less one: a part of a single
    host is no evidence of a word.
    """

    def words(text: Column) -> DataFrame:
        lowered = F.lower(F.coalesce(text, F.lit("")))
        found = F.regexp_extract_all(lowered, F.lit(_WORD), F.lit(0))
        return pages.select(F.explode(found).alias("word"))

    every = words(path_of(F.col(url)))
    if html is not None:
        title = F.regexp_extract(F.col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
        every = every.unionByName(words(F.regexp_replace(title, r"&#?\w+;", " ")))
    once = every.groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    parts = (
        hosts.select(F.explode(F.array_distinct(F.split("host", PARTS))).alias("word"))
        .groupBy("word")
        .agg((F.count(F.lit(1)) - 1).alias("count"))
    )
    return (
        once.unionByName(parts)
        .where((F.length("word") <= LONGEST) & (F.col("word") != ""))
        .groupBy("word")
        .agg(F.sum("count").alias("count"))
        .where("count > 0")
    )


def best_split(part: str, scores: dict[tuple[int, int], float], unknown: float) -> list[str]:
    """Words of greatest total score; a stretch without words costs ``unknown`` a character.

    Of equal splits the one with the longest last word wins, then that of the words before.
    """
    best, last = [0.0] + [-math.inf] * len(part), [0] * (len(part) + 1)
    for end in range(1, len(part) + 1):
        for start in range(max(0, end - LONGEST), end):
            score = scores.get((start, end))
            if score is None:
                if end - start > 1:
                    continue
                score = unknown
            if best[start] + score > best[end]:
                best[end], last[end] = best[start] + score, start
    words, end = [], len(part)
    while end:
        words.append(part[last[end] : end])
        end = last[end]
    return words[::-1]


def segmented_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, words) of distinct ``hosts.host``: the words of all its parts in order."""
    parts = (
        hosts.select(F.explode(F.split("host", PARTS)).alias("part")).where("part != ''").distinct()
    )
    total = counts.agg(F.sum("count")).first()[0] or 1
    size = F.length("part")
    spans = parts.select(
        "part", F.explode(F.sequence(F.lit(0), size - 1)).alias("start")
    ).select(
        "part",
        "start",
        F.explode(
            F.sequence(F.col("start") + 1, F.least(size, F.col("start") + LONGEST))
        ).alias("end"),
    )
    known = (
        spans.withColumn("word", F.expr("substring(part, start + 1, end - start)"))
        .join(counts.hint("merge"), "word")  # either side may be large, whatever is planned
        .groupBy("part")
        .agg(F.collect_list(F.struct("start", "end", "count")).alias("known"))
    )
    unknown = math.log(0.1 / total)

    @F.pandas_udf("array<string>")
    def split(part: pd.Series, known: pd.Series) -> pd.Series:
        out = []
        for text, found in zip(part, known, strict=True):
            scores = {
                (k["start"], k["end"]): math.log(k["count"] / total)
                for k in (found if found is not None else ())
            }
            out.append(best_split(text, scores, unknown))
        return pd.Series(out)

    words = stored(
        parts.join(known.hint("merge"), "part", "left").select("part", split("part", "known").alias("words")),
        "host-parts",
    )
    placed = hosts.select("host", F.posexplode(F.split("host", PARTS)).alias("at", "part"))
    return (
        placed.join(words, "part")
        .groupBy("host")
        .agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("found"))
        .select("host", F.flatten(F.col("found.words")).alias("words"))
    )


def _tokens(words: Column, path: Column) -> Column:
    """Hashed tokens of a url: words of its host and of its path, kept apart by a mark."""
    lowered = F.regexp_extract_all(F.lower(path), F.lit(_WORD), F.lit(0))
    of_host = F.coalesce(words, F.array().cast("array<string>"))
    marked = F.concat(
        F.transform(of_host, lambda w: F.concat(F.lit("h:"), w)),
        F.transform(lowered, lambda w: F.concat(F.lit("p:"), w)),
    )
    return F.transform(marked, lambda t: F.pmod(F.xxhash64(t), F.lit(1 << BITS)).cast("int"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule] = RULES,
    key: str = "page_id",
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """(key, host, path, rule, verdict, words, score) of every row.

    ``score`` is the log odds of blocking by naive Bayes; it is given for urls that a rule
    decides as well, but does not change them.
    """
    parsed = pages.select(
        F.col(key).alias("key"),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    ).withColumn("by_rule", rule_of(F.col("host"), F.col("path"), rules))
    hosts = parsed.where("host != ''").select("host").distinct()
    hosts = stored(hosts, "hosts")
    counts = stored(word_counts(pages, hosts, url, html), "words")
    words = segmented_hosts(hosts, counts)
    tokens = _tokens(F.col("words"), F.col("path"))
    judged = stored(parsed.join(words, "host", "left").withColumn("tokens", tokens), "urls")
    block = F.col("by_rule.verdict") == "block"
    learned = judged.where("by_rule is not null")
    urls = learned.agg(F.count(F.when(block, 1)), F.count(F.lit(1))).first()
    seen = (
        learned.select(F.explode("tokens").alias("token"), block.cast("int").alias("block"))
        .groupBy("token")
        .agg(F.sum("block").alias("block"), F.count(F.lit(1)).alias("all"))
        .toPandas()
    )
    of_block, of_allow = np.ones(1 << BITS), np.ones(1 << BITS)
    of_block[seen["token"]] += seen["block"]
    of_allow[seen["token"]] += seen["all"] - seen["block"]
    odds = np.log(of_block / of_block.sum()) - np.log(of_allow / of_allow.sum())
    prior = math.log((urls[0] + 1) / (urls[1] - urls[0] + 1))
    table = pages.sparkSession.sparkContext.broadcast(odds.astype(np.float32))

    def scored(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = table.value
        for tokens in frames:
            yield pd.Series(
                [prior + float(own[np.asarray(t, dtype=np.int64)].sum(dtype=float)) for t in tokens],
                dtype=float,
            )

    score = F.pandas_udf(scored, "double")
    out = judged.withColumn("score", score("tokens"))
    return out.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("by_rule.rule").alias("rule"),
        F.coalesce(
            F.col("by_rule.verdict"), F.when(F.col("score") > 0, F.lit("block")).otherwise("allow")
        ).alias("verdict"),
        "words",
        "score",
    )
