"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
import public_tokenizers

import corpus_pipeline
from seekframe.llm import (
    collocations,
    components,
    fill_middle,
    html_text,
    licenses,
    minhash,
    mixing,
    packing,
    paragraphs,
    quality_model,
    quality_rules,
    simhash,
    token_counts,
    url_filter,
)
from tests.llm import brute
from tests.llm.conftest import AWKWARD
from tests.llm.test_queries import check_packing

TEXTS = {row[0]: row[1] or "" for row in AWKWARD}


def test_paragraphs(spark, awkward, nothing):
    rows = paragraphs.document_versions(awkward).collect()
    assert len(rows) == len(AWKWARD)
    order = sorted(((r[0], r[1] or "") for r in AWKWARD), key=lambda r: (-r[0], r[1]))
    following = {k: order[(i + 1) % len(order)][1] for i, (k, _) in enumerate(order)}
    for r in rows:
        text = TEXTS[r.doc_id]
        assert r.n_chars == len(text)
        if r.doc_id != 8:
            new = paragraphs.edited(text, following[r.doc_id])
            assert r.edited_sha256 == paragraphs.hashlib.sha256(new.encode()).hexdigest()
    by_text = {}
    for r in rows:
        assert by_text.setdefault(TEXTS[r.doc_id], r.fingerprint) == r.fingerprint
    assert paragraphs.document_versions(nothing).collect() == []


def test_paragraphs_with_null_ids(spark):
    rows = [(None, "a b"), (3, "c d"), (2, "e f")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in paragraphs.document_versions(docs).collect()}
    assert set(found) == {None, 2, 3}
    edited = paragraphs.edited("a b", "c d")  # the null id is last, the first follows it
    assert found[None].edited_sha256 == paragraphs.hashlib.sha256(edited.encode()).hexdigest()


def test_peeling_recovers_differences_of_every_size():
    rng = np.random.default_rng(1)
    for size in (0, 1, 5, 60, 3000):
        shared = rng.integers(1, 1 << 62, 500).astype(np.uint64)
        a = np.concatenate([shared, rng.integers(1, 1 << 62, size).astype(np.uint64)])
        likeness = paragraphs.likeness([a, a], [shared, a])
        assert likeness[0] == pytest.approx(1 - size / (len(a) + 500)) and likeness[1] == 1.0


def test_mixing(spark, awkward, nothing):
    rows = mixing.mix_sources(awkward).collect()
    assert len(rows) == len(AWKWARD)
    sizes = {}
    for r in rows:
        size = len(brute.WORD.findall(TEXTS[r.doc_id]))
        assert r.size == size and 0 <= r.taken <= 2 * size
    for source in {r[3] for r in AWKWARD}:
        sizes[source] = sum(r.size for r in rows if r.source == source)
    wanted = brute.targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(wanted[r.source]) and r.source_size == sizes[r.source]
    assert mixing.mix_sources(nothing).collect() == []


def test_permutations_are_permutations():
    for size in (1, 2, 3, 7, 64, 1000):
        index = np.arange(size)
        image = mixing.permuted(index, np.full(size, size), np.full(size, 3))
        assert sorted(image) == list(range(size))


def test_quality_rules(spark, awkward, nothing):
    rows = quality_rules.judge_quality(awkward).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        counts = brute.quality_counts(TEXTS[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
    assert quality_rules.judge_quality(nothing).collect() == []


def test_the_order_of_rules_does_not_change_the_verdict(spark, awkward):
    rules = quality_rules.default_rules()
    counted = quality_rules.with_counts(awkward)
    orders = [list(rules), list(rules)[::-1]]
    kept = [
        counted.select(quality_rules.cascade(rules, order).isNull().alias("k")).collect()
        for order in orders
    ]
    assert kept[0] == kept[1]


def test_quality_rules_run_no_python(spark, awkward):
    judged = quality_rules.judge_quality(awkward).where("kept")
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_quality_model(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (6, 0), (7, 0), (None, 1), (5, None), (99, 1)], "doc_id bigint, quality int"
    )
    model = quality_model.train(awkward, labels)
    rows = quality_model.score_quality(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    empty = quality_model.train(nothing, labels.where("false"))
    assert empty.score("anything") == pytest.approx(0.5)
    assert quality_model.score_quality(nothing, model).collect() == []


def test_features_of_a_long_text_do_not_depend_on_pieces(monkeypatch):
    text = TEXTS[6][:20_000]
    whole = np.sort(np.concatenate(list(quality_model.features(text))))
    monkeypatch.setattr(quality_model, "PIECE", 1000)
    pieces = np.sort(np.concatenate(list(quality_model.features(text))))
    # Only the pairs of words across the ends of pieces are missing.
    assert len(whole) - len(pieces) == -(-len(text) // 1000) - 1 or len(whole) - len(pieces) <= 25


@pytest.mark.parametrize("tile", [2048, 3])
def test_simhash_groups(spark, tile):
    base = "the quick brown fox jumps over the lazy dog again and again until night falls".split()
    rows, rng = [(k, row[1]) for k, row in zip(range(1, 12), AWKWARD, strict=True)], np.random.default_rng(2)
    for i in range(60):
        words = base * 6
        words[int(rng.integers(len(words)))] = f"x{i % 17}"
        rows.append((100 + i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = simhash.near_duplicates(docs, tile=tile).collect()
    prints = {k: brute.simhash(t) for k, t in rows}
    wanted = brute.groups(prints)
    assert len(found) == len(rows)
    for r in found:
        assert r.fp & (2**64 - 1) == prints[r.doc_id] and r.component_id == wanted[r.doc_id]


def test_simhash_of_awkward_rows(spark, awkward, nothing):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    prints = {k: brute.simhash(t) for k, t in TEXTS.items()}
    assert {r.doc_id: r.component_id for r in rows} == brute.groups(prints)
    assert simhash.near_duplicates(nothing).collect() == []


def test_links_meet_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 1 << 63, 30)
    values = {int(c) for c in centres}
    for c in centres:
        for _ in range(8):
            flips = rng.choice(63, int(rng.integers(1, 5)), replace=False)
            values.add(int(c) ^ sum(1 << int(b) for b in flips))
    nodes = spark.createDataFrame([(v,) for v in values], "fp bigint")
    found = {(min(r.a, r.b), max(r.a, r.b)) for r in simhash.links(nodes).collect()}
    ordered = sorted(values)
    wanted = {
        (a, b)
        for i, b in enumerate(ordered)
        for a in ordered[:i]
        if (a ^ b).bit_count() <= 3
    }
    assert found == wanted


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    found = components.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    root = {r.node: r.root for r in found}
    assert len(found) == len(root)
    assert all(root[i] == 0 for i in range(41)) and all(root[i] == 100 for i in range(100, 140))


def test_token_counts(spark, awkward, nothing):
    rows = token_counts.count_tokens(awkward).collect()
    counter = token_counts.TokenCounter(*token_counts.unigram_vocabulary())
    assert sorted((r.doc_id, r.n_tokens) for r in rows) == sorted(
        (k[0], counter.text(k[1])) for k in AWKWARD
    )
    assert token_counts.count_tokens(nothing).collect() == []


def test_token_ties_and_unknown_characters():
    pieces = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("▁a", -2.0)]
    from tokenizers import models, pre_tokenizers

    exact = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=False))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(
        replacement=token_counts.MARK, prepend_scheme="always", split=True
    )
    counter = token_counts.TokenCounter(pieces, 0, False)
    for text in ("a", "aa", "aaa", "aaaa a", "xyz", "axxa", " a", "a  a", "", "▁a"):
        assert counter.text(text) == len(exact.encode(text, add_special_tokens=False).ids), text


def test_licenses(spark, awkward, nothing):
    rows = licenses.scan_licenses(awkward).collect()
    assert len(rows) == len(AWKWARD)
    for r in rows:
        n_words, starts, labels = brute.licenses(TEXTS[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (n_words, len(starts), ",".join(sorted(labels)))
    assert licenses.scan_licenses(nothing).collect() == []


def test_licenses_with_changed_words(spark):
    notice = next(t for t in licenses.NOTICES if t.label == "bsd").text.split()
    changed = notice[:9] + ["indeed"] + notice[9:]
    docs = spark.createDataFrame(
        [
            (1, " ".join(changed)),
            (2, " ".join(notice[:5])),
            (None, "under the mit license under the mit license"),
        ],
        "doc_id bigint, text string",
    )
    found = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    assert found[1].labels == "bsd" and found[1].n_base == 0
    assert found[2].labels == "" and found[2].score < licenses.MIN_COVER
    assert (found[None].n_base, found[None].first_word, found[None].last_word) == (2, 0, 4)


def test_packing(spark, awkward, nothing):
    rows = packing.pack(awkward.dropDuplicates(["doc_id"])).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_packing(rows, lambda k: tokenizer.encode(TEXTS[k], add_special_tokens=False).ids + [1])
    repeated = packing.pack(awkward).collect()
    assert sum(r.length for r in repeated if r.doc_id == 8) == 2 * sum(
        r.length for r in rows if r.doc_id == 8
    )
    assert len({(r.sequence_id, r.offset) for r in repeated}) == len(repeated)
    assert packing.pack(nothing).collect() == []


def test_cutting_stock_is_near_its_bound():
    rng = np.random.default_rng(3)
    sizes, demand = np.unique(rng.integers(1, 129, 5000), return_counts=True)
    patterns, used = packing.column_generation(demand.astype(float), sizes, 128)
    assert (patterns @ sizes <= 128).all()
    assert used.sum() <= 1.01 * (sizes * demand).sum() / 128 + 1
    times, left = packing.rounded(patterns, used, demand)
    assert ((times[:, None] * patterns).sum(axis=0) + left == demand).all() and (left >= 0).all()


HTML = [
    (1, "http://h.example/1", "<nav>Home</nav><article><h1>A &amp; B</h1><p>x<b>y</b>  z</article><footer>f</footer>"),
    (2, "http://h.example/2", None),
    (3, None, ""),
    (4, "no host", "plain < text &lt;here"),
    (5, "http://h.example/5", "<article><p>one<aside>side</aside><p class='ad'>buy<p>two<form>f</form><div class=comments>c</div></article>"),
    (5, "http://h.example/5", "<article><p>one<aside>side</aside><p class='ad'>buy<p>two<form>f</form><div class=comments>c</div></article>"),
    (6, "http://h.example/6", "<body><script>if (a<b) '</p>'</script><style>p{}</style><!-- <p>no</p> --><main>m<div id='cookie-notice'>c</div></main>"),
    (7, "http://h.example/7", "<p>" + "w " * 40_000),
] + [
    (
        10 + i,
        f"http://plain.example/{i}",
        "<div>Welcome to the site with news for all readers every day</div>"
        + f"<div>{' '.join(f'unique{i}x{j}' for j in range(30))}</div>",
    )
    for i in range(4)
]


def test_html(spark):
    schema = "page_id bigint, url string, html string"
    pages = spark.createDataFrame(HTML, schema).selectExpr("*", "'x' AS text", "1 AS page", "2 AS key")
    rows = html_text.extract_text(pages).collect()
    assert len(rows) == len(HTML)
    found = {r.page_id: r.text for r in rows}
    assert found[1] == "A & B xy z"
    assert found[2] == found[3] == ""
    assert found[4] == "plain < text <here"
    assert found[5] == "one two" and found[6] == "m"
    assert found[7] == " ".join(["w"] * 40_000)
    for i in range(4):
        assert found[10 + i].startswith(f"unique{i}x0") and "Welcome" not in found[10 + i]
    assert html_text.extract_text(spark.createDataFrame([], schema)).collect() == []


def test_urls(spark):
    schema = "page_id bigint, url string, html string"
    rows = [
        (1, None, None),
        (2, "no scheme", ""),
        (3, "http://EXAMPLE.net/en/x?y", "<title>good words here</title>"),
        (4, "http://goodwords.example.org/fr", "<title>good words</title>"),
        (4, "http://goodwords.example.org/fr", "<title>good words</title>"),
        (None, "ftp://a://b", None),
        (5, "http://net", None),
        (6, "http://x.net/", None),
        (7, "http://" + "a" * 5000 + ".example.com/" + "b" * 5000, None),
    ]
    pages = spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS host", "1 AS rule", "2 AS score")
    found = url_filter.filter_urls(pages).collect()
    assert len(found) == len(rows)
    by_id = {r.page_id: r for r in found}
    assert (by_id[1].host, by_id[2].path, by_id[1].rule) == ("", "", None)
    assert (by_id[3].host, by_id[3].rule, by_id[3].verdict) == ("example.net", "example.net/en/", "allow")
    assert by_id[5].rule is None and by_id[6].rule == "net/"
    assert by_id[None].host == "a:"
    assert by_id[4].words[:2] == ["good", "words"]
    assert url_filter.filter_urls(spark.createDataFrame([], schema)).collect() == []


def test_best_split_prefers_probable_words():
    scores = {(0, 2): -1.0, (2, 4): -1.0, (0, 4): -1.5, (0, 1): -3.0}
    assert url_filter.best_split("abcd", scores, -9.0) == ["abcd"]
    assert url_filter.best_split("abcde", scores, -9.0) == ["abcd", "e"]
    assert url_filter.best_split("", {}, -9.0) == []


def test_pipeline_of_awkward_rows(spark, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = corpus_pipeline.stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
            assert name == "packing" or docs.columns == columns
        assert docs.count() >= 0


def test_near_dedup_keeps_one_of_each_group(spark, awkward):
    kept = corpus_pipeline.near_dedup_stage(spark, awkward, "")
    assert [r.doc_id for r in kept.select("doc_id").orderBy("doc_id").collect()].count(8) <= 1
    groups = brute.groups({k: brute.simhash(t) for k, t in TEXTS.items()})
    assert kept.count() == len(set(groups.values()))
    assert kept.agg(F.count_distinct("doc_id")).first()[0] == len(set(groups.values()))


def _articles(host, extra, outside="", n=6):
    """Pages of a host with one paragraph of their own and an unclassed block in the article."""
    return [
        (
            i,
            f"http://{host}.example/{i}",
            f"<p>{outside}</p><article><p>{' '.join(f'{host}{i}x{j}' for j in range(20))}</p>"
            f"<div>{extra(i)}</div></article>",
        )
        for i in range(n)
    ]


def test_html_names_of_wrappers():
    article = "<p>one</p><p>two</p>"
    for html in (
        f'<div class="page has-sidebar"><article>{article}</article></div>',
        f'<div id="content" class="no-sidebar">{article}</div>',
        f'<article class="post comments-open">{article}</article>',
        f'<div class="layout-sidebar"><main>{article}</main></div>',
        f'<article><section class="related-work">{article}</section></article>',
        f'<article><div class="social-history">{article}</div></article>',
    ):
        assert html_text.read_page(html).settled() == "one two", html
    for name in ("sidebar left", "related-posts", "site-footer", "comment-12", "ad", "share-buttons"):
        html = f'<article>{article}<div class="{name}">three</div></article>'
        assert html_text.read_page(html).settled() == "one two", html


def test_html_repeats_decide_inside_articles(spark):
    notice = "we use small files on your device to make this site work"
    rows = (
        # A heading of every article, then a block that varies and repeats outside as well.
        _articles("bar", lambda i: "Ingredients")
        + [(100 + k, u, h) for k, u, h in _articles("note", lambda i: f"{notice} {i} {i}", notice)]
        # A passage that two of six articles share, and teasers of one article on every page.
        + [(200 + k, u, h) for k, u, h in _articles("quote", lambda i: notice if i < 2 else f"q{i}")]
        + [(300 + k, u, h) for k, u, h in _articles("tease", lambda i: notice if i < 1 else f"t{i}", notice)]
    )
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = {r.page_id: r.text for r in html_text.extract_text(pages).collect()}
    for i in range(6):
        assert found[i] == " ".join(f"bar{i}x{j}" for j in range(20)) + " Ingredients"
        assert found[100 + i] == " ".join(f"note{i}x{j}" for j in range(20))
    assert found[200].endswith(notice) and found[201].endswith(notice) and found[202].endswith("q2")
    assert found[300].endswith(notice) and found[301].endswith("t1")


def test_licenses_with_one_word_edited_anywhere(spark):
    rows, wanted = [], []
    for notice in licenses.NOTICES:
        words = notice.text.split()
        for i in range(1, len(words) - 1):
            for edited in (words[:i] + ["zz"] + words[i:], words[:i] + ["zz"] + words[i + 1 :]):
                rows.append((len(rows), "before it " + " ".join(edited) + " and after"))
                wanted.append(notice.label)
    others = {
        "licensed under the gnu general public license v3": "gpl-3",
        "licensed under the gnu general public license": "",
        "licensed under the gnu affero general public license version 3": "",
        "licensed under the gnu lesser general public license version 3": "lgpl",
        "licensed under a creative commons attribution noncommercial 4 0 international license": "",
        "licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa",
    }
    long = (
        "you can redistribute it and/or modify it under the terms of the GNU {}General Public"
        " License as published by the Free Software Foundation."
    )
    others |= {f"Licensed under the GNU General Public License version {n}": "" for n in (1, 2)}
    others |= {f"Licensed under the GNU General Public License v{n}." : "" for n in (1, 2)}
    others["subject to the terms of the Mozilla Public License, v. 1.1."] = ""
    others |= {
        long.format(""): "gpl",
        long.format("Affero "): "",
        long.format("Lesser "): "lgpl",
        long.format("Library "): "lgpl",
    }
    rows += [(10_000 + i, t) for i, t in enumerate(others)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in licenses.scan_licenses(docs).collect()}
    missed = [rows[i][1] for i, label in enumerate(wanted) if label not in found[i].labels.split(",")]
    assert not missed
    assert {t: found[10_000 + i].labels for i, t in enumerate(others)} == others


def test_packing_with_null_and_large_ids(spark):
    """Ids beyond the whole numbers of a double survive beside a null one."""
    texts = {(1 << 60) + i: f"text number {i} " * (3 + i * 7 % 400) for i in range(120)}
    texts[None] = "a row without an id " * 40
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(docs).collect()
    assert {r.doc_id for r in rows} == set(texts)
    check_packing(rows, lambda k: tokenizer.encode(texts[k], add_special_tokens=False).ids + [1])


def test_quality_rules_of_blank_lines_take_linear_time(spark):
    text = "\n" * 400_000 + "some words that are here " * 20
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    rules = quality_rules.default_rules()
    counted = quality_rules.with_counts(docs)
    began = time.perf_counter()
    counted.select(rules["bullets"].alias("b"), rules["ellipses"].alias("e")).collect()
    assert time.perf_counter() - began < 10


def test_minhash_of_awkward_rows(spark, awkward, nothing):
    rows = minhash.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    wanted = brute.shingle_groups(TEXTS.items())
    for r in rows:
        assert (r.n_shingles, r.component_id) == wanted[r.doc_id]
        assert r.kept == (r.component_id == r.doc_id)
    assert minhash.near_duplicates(nothing).collect() == []


def test_minhash_with_null_ids(spark):
    same = "one two three four five six seven"
    rows = [(None, same), (4, same), (None, "a text of its own here"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = sorted(
        ((r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()),
        key=str,
    )
    assert found == sorted(
        [(4, 4, True), (None, 4, False), (None, None, True), (None, None, True)], key=str
    )


@pytest.mark.parametrize("tile", [3, 1024])
def test_minhash_links_that_stars_leave_open(spark, tile):
    """Chains of edits around one passage, in tiles of few sets, against all pairs."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in rng.integers(0, 500, 60)]
    texts, words = {}, list(base)
    for i in range(120):
        if i % 30 == 0:
            words = list(base) if i % 60 else [f"v{j}" for j in rng.integers(0, 500, 60)]
        words[int(rng.integers(len(words)))] = f"x{i}"
        texts[i] = " ".join(words)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, tile=tile).collect()}
    wanted = brute.shingle_groups(texts.items())
    assert found == {k: v[1] for k, v in wanted.items()}


def test_sketches_fill_and_estimate_similarity():
    rng = np.random.default_rng(5)
    for size in (1, 2, 40, 3000):
        shared = rng.integers(0, 1 << 63, 4 * size).astype(np.uint64)
        a = np.concatenate([shared, rng.integers(0, 1 << 63, size).astype(np.uint64)])
        one, two = minhash.sketch(a), minhash.sketch(shared)
        assert (one != np.uint64(0xFFFFFFFFFFFFFFFF)).all()
        assert abs((one == two).mean() - 0.8) < 0.15


def test_forest_links_all_near_sets():
    sets = [np.arange(0, 100), np.arange(5, 105), np.arange(10, 110), np.arange(500, 600)]
    links = minhash.forest([0, 3], [0, 1, 2, 3], [sets[0], sets[3]], sets, 80)
    assert sorted(map(sorted, links)) == [[0, 1], [0, 2]]


def test_collocations_of_awkward_rows(spark, awkward, nothing):
    found = collocations.collocations(awkward, min_count=3, top=50).collect()
    wanted = brute.collocations([(r[1], r[2]) for r in AWKWARD], 3, 50)
    assert [tuple(r) for r in sorted(found, key=lambda r: (r.lang, r.rank))] == wanted
    assert collocations.collocations(nothing).collect() == []


def test_survivors_hold_every_frequent_ngram(spark):
    """Summaries far too small for their mass still lose no n-gram at the threshold."""
    rng = np.random.default_rng(7)
    rows = [(" ".join(f"w{i}" for i in rng.zipf(1.4, 300) % 900), "en") for _ in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    kept = collocations.surviving_ngrams(docs, 20, capacity=8)
    counts = collocations.ngram_counts(docs, kept).where("f >= 20 AND size > 0")
    found = {(r.lang, r.phrase): r.f for r in counts.collect()}
    every = brute.ngrams(rows)[0]
    assert found == {k: n for k, n in every.items() if n >= 20}


def test_a_summary_takes_less_than_its_threshold():
    rng = np.random.default_rng(9)
    summary, exact = collocations.Summary(50, 30), {}
    for _ in range(200):
        keys, counts = np.unique(rng.zipf(1.3, 400) % 5000, return_counts=True)
        for k, n in zip(keys.tolist(), counts.tolist(), strict=True):
            exact[k] = exact.get(k, 0) + n
        summary.merge(keys.astype(np.uint64), counts)
    kept = set(summary.survivors().tolist())
    assert summary.taken < 30
    assert {k for k, n in exact.items() if n >= 30} <= kept


@pytest.mark.parametrize("frame", [7, 64, fill_middle.FRAME])
def test_fill_middle_of_awkward_rows(spark, awkward, frame):
    """Frames of a few bytes cut words, white space and characters everywhere."""
    short = awkward.where(F.coalesce(F.length("text"), F.lit(0)) < (1 << 30 if frame > 64 else 999))
    frames = fill_middle.store_frames(short, frame=frame)
    made = fill_middle.with_digests(fill_middle.fill_in_middle(frames, fim_percent=100))
    rows = made.drop("output").collect()
    assert len(rows) == short.count()
    assert {r.form for r in rows} == {"plain", "spm", "psm"} or frame <= 64
    for r in rows:
        wanted = brute.fill_middle(r.doc_id, TEXTS[r.doc_id], fim_percent=100)
        assert tuple(r)[1:] == wanted


def test_fill_middle_of_an_empty_table(spark, nothing):
    made = fill_middle.fill_in_middle(fill_middle.store_frames(nothing))
    assert fill_middle.with_digests(made).collect() == []


def test_cut_places_agree_with_plain_tokens():
    """Every cut of texts of mixed white space, in frames of every small size."""
    for text in ("a  b\n\tc", "  lead and trail \n", "é日本 \U0001f600x y", " ", "x"):
        data = text.encode()
        tokens = re.findall(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", data)
        for size in range(4, 12):
            units, chars, frames = fill_middle.compressed(data, size)
            stored_text = fill_middle.Seekable(units, chars, frames)
            assert (units, chars) == (len(tokens), len(text))
            for cut in range(units + 1):
                place = stored_text.find(cut)
                held = b"".join(fill_middle.streamed(stored_text.between((0, 0, 0), place)))
                assert held == b"".join(tokens[:cut])
                assert place[2] == len(held.decode())
