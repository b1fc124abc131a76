"""The registered queries of the subpackage against brute force, over whole small tables."""

import re
import struct
import zlib
from html import unescape

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

import corpus_pipeline
from seekframe.llm import token_counts
from seekframe.llm.queries import QUERIES
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text for r in rows}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def run(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    assert rows
    return rows


def test_op1(spark, texts):
    wanted = brute.versions(texts.items())
    rows = run(spark, "op1_paragraphs")
    assert len(rows) == len(texts)
    for r in rows:
        n_chars, digest, near_edited, near_next = wanted[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n_chars, digest)
        assert r.near_edited == pytest.approx(near_edited)
        assert r.near_next == pytest.approx(near_next)
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert len(set(prints.values())) == len({texts[k]: v for k, v in prints.items()})


def test_op2(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    found = {r.page_id: r for r in run(spark, "op2_html_text")}
    assert len(found) == len(pages)
    for page in pages:
        article = re.search(r"<article>(.*?)(</article>|<footer|$)", page.html, re.DOTALL)[1]
        text = " ".join(unescape(re.sub(r"<[^>]*>", " ", article)).split())
        assert " ".join(found[page.page_id].text.split()) == text
        assert found[page.page_id].n_chars == len(found[page.page_id].text)


def test_op3(spark, texts):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    source = {r.doc_id: r.source for r in docs}
    rows = run(spark, "op3_mixing")
    sizes, taken = {}, {}
    for r in rows:
        assert r.size == len(brute.WORD.findall(texts[r.doc_id]))
        assert 0 <= r.taken <= 2 * r.size
        sizes[source[r.doc_id]] = sizes.get(source[r.doc_id], 0) + r.size
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
    wanted = brute.targets(sizes)
    for r in rows:
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(wanted[source[r.doc_id]])
    for name, target in wanted.items():
        assert abs(taken[name] - target) <= max(160, 0.05 * target)
    again = run(spark, "op3_mixing")
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_op4(spark, texts):
    for r in run(spark, "op4_quality_rules"):
        counts = brute.quality_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_op4_rejects_and_keeps_as_labelled(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = QUERIES["op4_quality_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id")
    judged = rows.where("not base_failed").collect()
    good = [r.kept for r in judged if r.quality == 1]
    bad = [r.kept for r in judged if r.quality == 0]
    assert sum(good) >= 0.99 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_op5_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = QUERIES["op5_quality_model"](spark, sf_dir).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in judged) >= 0.95 * len(judged)


def test_op6(spark, texts):
    prints = {k: brute.simhash(t) for k, t in texts.items()}
    wanted = brute.groups(prints)
    rows = run(spark, "op6_simhash")
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", wanted[r.doc_id])


def test_op7(spark, texts):
    pieces, unknown, byte_pieces = token_counts.unigram_vocabulary()
    exact = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=byte_pieces))
    exact.pre_tokenizer = pre_tokenizers.Metaspace(
        replacement=token_counts.MARK, prepend_scheme="always", split=True
    )
    for r in run(spark, "op7_token_counts"):
        assert r.n_tokens == len(exact.encode(texts[r.doc_id], add_special_tokens=False).ids)


RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def test_op8(spark):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()}
    rows = run(spark, "op8_url_filter")
    assert len(rows) == len(urls)
    for r in rows:
        host, path = brute.url_parts(urls[r.page_id])
        assert (r.host, r.path) == (host, path)
        fits = []
        for rule, verdict in RULES:
            own, _, start = rule.partition("/")
            if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
                fits.append((len(rule), rule, verdict))
        if fits:
            assert (r.rule, r.verdict) == max(fits)[1:]
        else:
            assert r.rule is None and r.verdict in ("allow", "block")


def test_op9(spark, texts):
    for r in run(spark, "op9_licenses"):
        n_words, starts, labels = brute.licenses(texts[r.doc_id])
        assert (r.n_words, r.n_base) == (n_words, len(starts))
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted(labels))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1


def check_packing(rows, ids_of):
    own, sequences = {}, {}
    for r in rows:
        own.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for key, pieces in own.items():
        ids, at = ids_of(key), 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            part = ids[at : at + r.length]
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(part)}I", *part))
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert 0 < at <= 2048
        total += at
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    return padding / total


def test_op10(spark, texts, tokenizer):
    rows = run(spark, "op10_packing")
    assert {r.doc_id for r in rows} == set(texts)
    padding = check_packing(
        rows, lambda k: tokenizer.encode(texts[k], add_special_tokens=False).ids + [1]
    )
    assert padding < 0.02


def test_op11(spark, texts):
    wanted = brute.shingle_groups(texts.items())
    rows = run(spark, "op11_minhash")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_op12(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", "lang").collect()
    rows = sorted(run(spark, "op12_collocations"), key=lambda r: (r.lang, r.rank))
    assert [tuple(r) for r in rows] == brute.collocations(docs)


def test_op13(spark, texts):
    rows = run(spark, "op13_fill_middle")
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r)[1:] == brute.fill_middle(r.doc_id, texts[r.doc_id])
        assert r.output_sha256 == r.restored_sha256 or r.form != "plain"


def test_pipeline(spark, texts, tokenizer):
    """Every stage against brute force on its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), f"test-{name}")
        after = [r.doc_id for r in docs.select("doc_id").collect()]
        sizes.append(len(after))
        assert set(after) <= before
        if name == "packing":
            continue
        assert docs.columns == columns
        if name == "quality_rules":
            for key in before - set(after):
                counts = brute.quality_counts(texts[key])
                failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
                assert failed or key not in after
        if name == "near_dedup":
            groups = brute.groups({k: brute.simhash(texts[k]) for k in before})
            assert sorted(after) == sorted(set(groups.values()))
        if name == "mixing":
            assert max(after.count(k) for k in set(after)) <= 2
            copies = {k: after.count(k) for k in set(after)}
    # A document that was copied has its pieces as often.
    pieces = {}
    for r in docs.collect():
        pieces[r.doc_id] = pieces.get(r.doc_id, 0) + r.length
    for key, length in pieces.items():
        ids = tokenizer.encode(texts[key], add_special_tokens=False).ids
        assert length == copies[key] * (len(ids) + 1)
    assert all(sizes)
