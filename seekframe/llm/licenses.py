"""License scan by diagonal voting.

Every text is cut once. All rolling word k-grams of the texts are joined, by a 64-bit hash, to
the k-grams of the license templates. A match at word p of a text and word q of a template
votes for the diagonal p - q: an unbroken quotation puts all its votes on one diagonal, an
insertion or omission moves the rest to a neighbouring one. Votes are summed per diagonal and
neighbouring diagonals are merged into spans.

Spans are verified in their texts. A span stands if its exact matches cover ``MIN_COVER`` of
the template, or if that share of the template's words can be aligned with the text around
its diagonals: an edited word breaks up to three k-grams, half of a short notice. Notices
differ by one word, as lgpl and gpl do, so of the templates that stand at one place only the
best remain: most aligned words less edits, then most aligned words. Further wordings and other
licenses take part in that, so that another version of a license is not taken for its own.
``MIN_COVER`` of the words always leaves an unbroken k-gram.

Templates marked exact are phrases whose words must stand consecutively: each diagonal with
all the votes is one place, and diagonals are not merged.

Defined results: a null text counts as empty and has no words. Rows that repeat are scanned
once and returned as often as they came; a null id is an id like any other. Only the id and
text columns are used, so further columns cannot clash.
"""

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekframe.llm.common import stored, text_of
from seekframe.llm.ngrams import LOWER, blocks, joined, mixed, salts, words

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
GRAM = 3
GAP = 4
MIN_COVER = 0.8

_NONE = -1  # template of the row that stands for the text itself
_TEXT = 0  # its hash
_OUTSIDE = np.array([not re.match(rb"[0-9a-z\x80-\xff]", bytes([c])) for c in range(256)])
_RUN = re.compile(rb"[0-9a-z\x80-\xff]+")  # words of lower-cased bytes
_PLACES = salts(GRAM, 9) | np.uint64(1)


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    exact: bool = False


#: Fixed phrases and their labels.
PHRASES = (
    Template("mit", "under the mit license", True),
    Template("apache-2", "apache license version 2", True),
    Template("cc-by-nc", "cc by nc", True),
)

#: Notices that the method looks for, copies with small changes included.
NOTICES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files to deal in the software without"
        " restriction",
    ),
    Template("gpl-3", "licensed under the gnu general public license version 3"),
    Template(
        "gpl",
        "redistribute it and or modify it under the terms of the gnu general public license as"
        " published by the free software foundation",
    ),
    Template("lgpl", "licensed under the gnu lesser general public license"),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    Template("apache-2", "licensed under the apache license version 2 0"),
    Template("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    Template("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)


_LONG_GPL = (
    "redistribute it and or modify it under the terms of the gnu {} general public license as"
    " published by the free software foundation"
)

#: Other wordings of notices.
VARIANTS = (
    Template("gpl-3", "licensed under the gnu general public license v3"),
    Template("lgpl", _LONG_GPL.format("lesser")),
    Template("lgpl", _LONG_GPL.format("library")),
)

#: Other licenses whose wording is near a notice; they only keep it from being named.
RIVALS = (
    Template("gpl-any", "licensed under the gnu general public license"),
    Template("gpl-1", "licensed under the gnu general public license version 1"),
    Template("gpl-1", "licensed under the gnu general public license v1"),
    Template("gpl-2", "licensed under the gnu general public license version 2"),
    Template("gpl-2", "licensed under the gnu general public license v2"),
    Template("agpl-3", _LONG_GPL.format("affero")),
    Template("agpl-3", "licensed under the gnu affero general public license version 3"),
    Template("agpl-3", "licensed under the gnu affero general public license v3"),
    Template("agpl-3", "licensed under the gnu affero general public license"),
    Template("lgpl", "licensed under the gnu lesser general public license version 3"),
    Template("lgpl", "licensed under the gnu lesser general public license v3"),
    Template("apache-1", "licensed under the apache license version 1 1"),
    Template("mpl-1", "subject to the terms of the mozilla public license v 1 1"),
    Template("mpl-1", "subject to the terms of the mozilla public license version 1 1"),
) + tuple(
    Template(label, f"licensed under a creative commons attribution {kind} {end}")
    for label, kind in (
        ("cc-by-sa", "sharealike"),
        ("cc-by-nc", "noncommercial"),
        ("cc-by-nd", "noderivatives"),
        ("cc-by-nc-sa", "noncommercial sharealike"),
        ("cc-by-nc-nd", "noncommercial noderivatives"),
    )
    for end in ("license", "4 0 international license")
)


def gram_hashes(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """Per text the number of its words and the hashes of its k-grams, by first word."""
    for first, last in blocks(texts):
        data, begins = joined(texts[first:last])
        starts, _, (hashed,) = words(data, _OUTSIDE)
        bounds = np.searchsorted(starts, np.append(begins, len(data))).tolist()
        grams = np.zeros(max(len(hashed) - GRAM + 1, 0), np.uint64)
        for i in range(GRAM):
            grams += hashed[i : i + len(grams)] * _PLACES[i]
        grams = mixed(grams).view(np.int64)
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            yield high - low, grams[low : max(low, high - GRAM + 1)]


def _source(docs: DataFrame, key: str, text: str) -> DataFrame:
    source = docs.select(F.col(key).alias("key"), text_of(text).alias("body"))
    return source.select("key", F.xxhash64("body").alias("text_hash"), "body")


def text_grams(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text_hash, n_words, grams) per row; the last gram stands for the text itself."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, grams = [], []
            for size, hashes in gram_hashes(batch.column(2).cast(pa.binary()).to_pylist()):
                sizes.append(size)
                grams.append(np.append(hashes, _TEXT))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int32()),
                    pa.array(grams, pa.list_(pa.int64())),
                ],
                names=["key", "text_hash", "n_words", "grams"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return _source(docs, key, text).mapInArrow(
        cut, f"key {kind}, text_hash bigint, n_words int, grams array<bigint>"
    )


def _template_grams(spark, templates: Sequence[Template]) -> DataFrame:
    """One row per k-gram of a template, and one for the text itself."""
    rows = [(_TEXT, _NONE, 0, 0, "", False)]
    for number, template in enumerate(templates):
        ((size, hashes),) = gram_hashes([template.text.encode()])
        if size < GRAM:
            raise ValueError(f"template of fewer than {GRAM} words: {template.text!r}")
        rows += [
            (h, number, i, size, template.label, template.exact)
            for i, h in enumerate(hashes.tolist())
        ]
    schema = "h bigint, template int, t_pos int, t_words int, label string, exact boolean"
    return spark.createDataFrame(rows, schema)


def align(template: list[bytes], window: list[bytes]) -> tuple[int, int, int, int]:
    """(matched words less edits, matched words, first, end) of the best place in ``window``."""
    above = [(0, 0, i) for i in range(len(window) + 1)]
    for word in template:
        score, matched, start = above[0]
        row = [(score - 1, matched, start)]
        for i, other in enumerate(window):
            score, matched, start = above[i]
            taken = (score + 1, matched + 1, start) if word == other else (score - 1, matched, start)
            left, up = row[i], above[i + 1]
            row.append(max(taken, (left[0] - 1, *left[1:]), (up[0] - 1, *up[1:])))
        above = row
    end = max(range(len(above)), key=lambda i: (above[i][:2], -i))
    return (*above[end], end)


def best_places(
    text: bytes, asks: list[dict], templates: Sequence[Template], known: int, min_cover: float
) -> list[tuple[str, float, bool]]:
    """(label, cover, verified) of the spans that no better template beats.

    ``asks`` are the spans of ``text``, whose A-Z are in lower case. Templates from number
    ``known`` on only compete.
    """
    cut = _RUN.findall(text)
    spans = []
    for ask in asks:
        template = templates[ask["template"]].text.encode().split(b" ")
        low = max(0, ask["low"] - GAP)
        window = cut[low : ask["high"] + len(template) + GAP]
        cover, place = ask["cover"], None
        shared = (Counter(template) & Counter(window)).total()
        if max(cover, shared / len(template)) >= min_cover:
            score, matched, first, end = align(template, window)
            cover = max(cover, matched / max(len(template), end - first))
            if cover >= min_cover:
                place = (score, matched, low + first, low + end)
        spans.append((templates[ask["template"]].label, cover, place, ask["template"] < known))
    standing = [(label, place) for label, _, place, _ in spans if place]

    def beaten(label: str, place: tuple | None) -> bool:
        if place is None:
            return False
        # The label counts by the best of its own templates there.
        here = [(o[:2], name) for name, o in standing if o[2] < place[3] and place[2] < o[3]]
        best = max(rank for rank, name in here if name == label)
        return any(rank > best for rank, name in here if name != label)

    return [
        (label, cover, place is not None)
        for label, cover, place, own in spans
        if own and not beaten(label, place)
    ]


def verified_spans(
    docs: DataFrame,
    spans: DataFrame,
    templates: Sequence[Template],
    known: int,
    min_cover: float,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, text_hash, label, cover, verified) of the merged ``spans``, by ``best_places``.

    Texts without a k-gram of a template do not get here. Rows that repeat give equal rows.
    """
    asked = (
        spans.groupBy(F.col("key").alias("own"), F.col("text_hash").alias("h"))
        .agg(F.collect_list(F.struct("template", "low", "high", "cover")).alias("asks"))
        .hint("merge")
    )
    source = _source(docs, key, text)
    met = source.join(
        asked, (source["text_hash"] == asked["h"]) & source["key"].eqNullSafe(asked["own"])
    ).select("key", "text_hash", "body", "asks")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, at = [], []
            texts = batch.column(2).cast(pa.binary())
            for i, asks in enumerate(batch.column(3).to_pylist()):
                body = texts[i].as_py().translate(LOWER)
                places = best_places(body, asks, templates, known, min_cover)
                found += places
                at += [i] * len(places)
            columns = list(zip(*found, strict=True)) or [()] * 3
            kinds = (pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).take(pa.array(at, pa.int64())) for i in (0, 1)]
                + [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["key", "text_hash", "label", "cover", "verified"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return met.mapInArrow(
        look, f"key {kind}, text_hash bigint, label string, cover double, verified boolean"
    )


def license_spans(
    docs: DataFrame,
    templates: Sequence[Template] = PHRASES + NOTICES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, text_hash, n_words, copies, template, label, exact, first, last, low, high, cover).

    One row per span, low and high being its diagonals; each text also has one row with
    template -1. The template table is given by the caller as a list and broadcast; its size
    does not depend on the documents.
    """
    placed = text_grams(docs, key, text).select(
        "key", "text_hash", "n_words", F.posexplode("grams").alias("pos", "h")
    )
    hits = placed.join(F.broadcast(_template_grams(docs.sparkSession, templates)), "h")
    text_key = ["key", "text_hash", "n_words"]
    votes = (
        hits.withColumn(
            "diagonal", F.when(F.col("template") == _NONE, 0).otherwise(F.col("pos") - F.col("t_pos"))
        )
        .groupBy(*text_key, "template", "t_words", "label", "exact", "diagonal")
        .agg(
            F.count(F.lit(1)).alias("votes"),
            F.min("pos").alias("first"),
            (F.max("pos") + GRAM - 1).alias("last"),
        )
    )
    per_text = Window.partitionBy(*text_key)
    votes = votes.withColumn(
        "copies", F.max(F.when(F.col("template") == _NONE, F.col("votes"))).over(per_text)
    ).withColumn("votes", F.col("votes") / F.col("copies"))
    near = Window.partitionBy(*text_key, "template").orderBy("diagonal")
    opens = F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(near) > GAP)
    spans = (
        votes.withColumn("opens", F.coalesce(opens, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("opens").over(near))
        .groupBy(*text_key, "copies", "template", "t_words", "label", "exact", "span")
        .agg(
            F.sum("votes").alias("votes"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
            F.min("diagonal").alias("low"),
            F.max("diagonal").alias("high"),
        )
    )
    share = F.col("votes") / (F.col("t_words") - (GRAM - 1))
    length = F.col("last") - F.col("first") + 1
    # A span much longer than its template holds words of other text between the matches.
    cover = F.least(share, F.lit(1.0)) * F.least(
        F.lit(1.0), F.lit(1.5) * F.col("t_words") / length
    )
    return spans.withColumn("cover", F.when(F.col("template") == _NONE, 0.0).otherwise(cover)).drop(
        "span", "votes", "t_words"
    )


def scan_licenses(
    docs: DataFrame,
    templates: Sequence[Template] = PHRASES + NOTICES,
    min_cover: float = MIN_COVER,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row of ``docs``: the places of exact phrases and the labels of all verified spans.

    Columns: key, n_words, n_base, first_word, last_word, base_labels, labels, score; the
    score is the best cover of any span that is not beaten, 1.0 where a phrase stands.
    """
    every = [*templates, *VARIANTS, *RIVALS]
    known = len(templates) + len(VARIANTS)
    spans = stored(license_spans(docs, every, key, text), "license-spans")
    near = spans.where((F.col("template") != _NONE) & ~F.col("exact"))
    labelled = verified_spans(docs, near, every, known, min_cover, key, text)
    named = {t.label for t in templates if not t.exact}
    labelled = labelled.where(F.col("label").isin(sorted(named))).withColumn("exact", F.lit(False))
    phrases = spans.where(F.col("exact") | (F.col("template") == _NONE)).withColumn(
        "verified", F.col("exact") & (F.col("cover") >= 1.0)
    )
    rows = phrases.unionByName(labelled, allowMissingColumns=True)
    place = F.col("exact") & F.col("verified")

    def listed(condition: Column) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(condition, F.col("label")))), ",")

    scanned = rows.groupBy("key", "text_hash").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.max("copies").alias("copies"),
        F.count(F.when(place, 1)).alias("n_base"),
        F.min(F.when(place, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(place, F.col("first"))).cast("bigint").alias("last_word"),
        listed(place).alias("base_labels"),
        listed(F.col("verified")).alias("labels"),
        F.max(F.when(F.col("exact") & ~place, 0.0).otherwise(F.col("cover"))).alias("score"),
    )
    again = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return scanned.withColumn("copy", again).select(
        F.col("key").alias(key),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        "base_labels",
        "labels",
        "score",
    )
