"""Registered queries: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registered import inputs
from seekframe.functions.hashing import hash_encode
from seekframe.functions.text import compose
from seekframe.functions.vectors import cosine_distance, dot, l2_normalize, vector_literal
from seekframe.operators.ann import assign_cells, ivf_search, label_centres, nprobe_for
from seekframe.operators.chunk import chunk_documents
from seekframe.operators.embed import encode, mean_pool, token_rows
from seekframe.operators.growth import bounded_search
from seekframe.operators.fuse import (
    label_lists,
    list_report,
    ranked_names,
    reciprocal_rank_fusion,
)
from seekframe.operators import keyword
from seekframe.operators.keyword import keyword_search
from seekframe.operators.rank import attach_payload
from seekframe.operators.vector import vector_search
from seekframe.plans import messages as msg
from seekframe.plans import prompt
from seekframe.plans.hybrid import both_searches, hybrid_search
from seekframe.session import spread
from seekframe.sources.corpus import filter_paths, first_match, load_catalog, read_tree
from seekframe.sources.tables import open_current, publish, with_vectors

FAQ_BOOSTS = {"question": 3.0, "section": 0.5}
COURSE = "src1"
FAQ_SCHEMA = "doc_id bigint, course string, section string, question string, answer string"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Sources, projections, filters


@query
def compose_text(spark, sf):
    return inputs.faq(spark, sf).select("doc_id", compose("question", "answer").alias("embed_text"))


@query
def path_filter(spark, sf):
    pages = inputs.table(spark, sf, "pages").select("page_id", "url")
    return filter_paths(pages, "url", "/en/", {"html"})


@query
def first_page(spark, sf):
    pages = inputs.table(spark, sf, "pages")
    return first_match(pages, "url", "/en/", key="page_id")


@query
def catalog_load(spark, sf):
    root = inputs.new_folder(spark, sf, "landed")
    entries = inputs.faq(spark, sf)
    entries.withColumn("file", F.col("course")).write.partitionBy("file").json(root)
    catalog = entries.select(F.concat(F.lit("/file="), "course").alias("path")).distinct()
    return load_catalog(catalog, root, FAQ_SCHEMA, multi_line=False)


@query
def catalog_arrays(spark, sf):
    root = inputs.new_folder(spark, sf, "arrays")
    fields = ["doc_id", "course", "section", "question", "answer"]
    entry = F.struct(*fields)
    batch = F.floor(F.col("doc_id") / 20).cast("string").alias("batch")
    arrays = inputs.faq(spark, sf).groupBy(batch).agg(F.to_json(F.collect_list(entry)).alias("value"))
    arrays.write.partitionBy("batch").text(root)
    catalog = arrays.select(F.concat(F.lit("batch="), "batch").alias("path"))
    return load_catalog(catalog, root, FAQ_SCHEMA)


@query
def file_tree(spark, sf):
    root = inputs.new_folder(spark, sf, "page files")
    name = F.concat(F.lit("page "), F.col("page_id").cast("string"))
    pages = inputs.table(spark, sf, "pages").select(name.alias("name"), F.col("html").alias("value"))
    inputs.land_files(pages, root)
    files = read_tree(spark, root, {"txt"}, F.col("filename").startswith("name=page "))
    folder = F.regexp_extract("filename", "^name=([^/]*)/[^/]*$", 1)
    return files.select(folder.alias("filename"), "content").select(
        "filename", compose("filename", "content").alias("embed_text")
    )


@query
def vector_table(spark, sf):
    root = inputs.new_folder(spark, sf, "vector_table")
    entries = inputs.faq(spark, sf)
    encoded = spread(entries, "doc_id").select(
        "doc_id", hash_encode(compose("question", "answer"), 384, normalize=False).alias("vec")
    )
    publish(with_vectors(entries, encoded, 384), root)
    return open_current(spark, root).select(
        "doc_id", "course", "section", vector_literal(F.col("vec"), 1).alias("literal")
    )


@query
def vector_export(spark, sf):
    return inputs.vectors(spark, sf).select(
        "vec_id", vector_literal(F.col("vec")).alias("literal")
    )


# Chunks and keyword search


@query
def chunk_sliding(spark, sf):
    docs = inputs.table(spark, sf, "documents").select("doc_id", "text")
    return chunk_documents(spread(docs, "doc_id"), "text", 2000, 1000)


@query
def term_stats(spark, sf):
    terms = inputs.faq_index(spark, sf).terms
    return terms.select("field", "term", "df", F.round("idf", 6).alias("idf"))


@query
def postings(spark, sf):
    rows = keyword.postings(inputs.faq_index(spark, sf))
    return rows.select("doc_id", "course", "field", "term", F.round("weight", 6).alias("weight"))


@query
def keyword_plain(spark, sf):
    return keyword_search(inputs.faq_index(spark, sf), inputs.questions(spark, sf), 5)


@query
def keyword_boosted(spark, sf):
    return keyword_search(inputs.faq_index(spark, sf), inputs.questions(spark, sf), 5, FAQ_BOOSTS)


@query
def keyword_filtered(spark, sf):
    return keyword_search(
        inputs.faq_index(spark, sf),
        inputs.questions(spark, sf),
        5,
        FAQ_BOOSTS,
        {"course": COURSE},
    )


@query
def keyword_single(spark, sf):
    return keyword_search(inputs.faq_index(spark, sf), inputs.questions(spark, sf), 1)


@query
def keyword_match(spark, sf):
    course = F.concat(F.lit("src"), (F.col("query_id") % 20).cast("string"))
    asked = inputs.questions(spark, sf).withColumn("course", course)
    return keyword_search(
        inputs.faq_index(spark, sf), asked, 5, FAQ_BOOSTS, match=("course",)
    )


@query
def keyword_chunks_filtered(spark, sf):
    return keyword_search(
        inputs.chunk_index(spark, sf), inputs.questions(spark, sf), 5, filters={"source": COURSE}
    )


@query
def keyword_chunks(spark, sf):
    return keyword_search(
        inputs.chunk_index(spark, sf), inputs.questions(spark, sf), 5, {"content": 3.0}
    )


# Embedding


@query
def hash_embed(spark, sf):
    docs = spread(inputs.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return (
        docs.select("doc_id", hash_encode(F.col("text")).alias("vec"))
        .select("doc_id", F.posexplode("vec").alias("dim", "value"))
        .where(F.col("value") != 0)
        .select("doc_id", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))
    )


def _text_shape_encoder():
    """A stand-in for a model: length, count of one letter, count of line breaks."""
    import numpy as np

    def encode_batch(texts):
        flat = [str(t) for t in texts.ravel()]
        return np.array([[len(t), t.count("e"), t.count("\n")] for t in flat], dtype=np.float32)

    return encode_batch


@query
def encode_plugin(spark, sf):
    docs = spread(inputs.table(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", encode(F.col("text"), _text_shape_encoder).alias("vec")).select(
        "doc_id",
        *[F.col("vec")[i].cast("double").alias(n) for i, n in enumerate(["chars", "es", "breaks"])],
    )


@query
def token_pooled(spark, sf):
    rows = token_rows(inputs.questions(spark, sf), "query_id")
    pooled = mean_pool(rows, "query_id").select("query_id", l2_normalize(F.col("vec")).alias("vec"))
    return (
        pooled.select("query_id", F.posexplode("vec").alias("dim", "value"))
        .where(F.col("value") != 0)
        .select("query_id", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))
    )


@query
def mean_pooled(spark, sf):
    rows = inputs.table(spark, sf, "conversations").select(
        "conv_id",
        (F.col("role") != "system").cast("int").alias("mask"),
        hash_encode(F.col("text")).alias("vec"),
    )
    return (
        mean_pool(rows.where(F.col("vec").isNotNull()), "conv_id")
        .select("conv_id", F.posexplode("vec").alias("dim", "value"))
        .select("conv_id", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))
    )


# Vector search


@query
def vector_distance(spark, sf):
    centres = label_centres(inputs.vectors(spark, sf), "label").select(
        F.col("cell").alias("label"), F.col("vec").alias("centre")
    )
    pair = F.col("vec"), F.col("centre")
    return (
        inputs.vectors(spark, sf)
        .join(centres, "label")
        .select(
            "vec_id",
            F.round(dot(*pair), 6).alias("inner_product"),
            F.round(cosine_distance(*pair), 6).alias("distance"),
        )
    )


@query
def vector_argmax(spark, sf):
    return vector_search(
        inputs.vectors(spark, sf),
        inputs.vector_queries(spark, sf),
        1,
        key=("vec_id",),
        metric="dot",
    ).drop("rank")


@query
def vector_topk(spark, sf):
    return vector_search(
        inputs.vectors(spark, sf),
        inputs.vector_queries(spark, sf),
        5,
        key=("vec_id",),
        metric="dot",
    )


@query
def vector_filtered(spark, sf):
    return vector_search(
        inputs.vectors(spark, sf),
        inputs.vector_queries(spark, sf),
        5,
        key=("vec_id",),
        on=("label",),
        metric="dot",
    )


@query
def vector_similarity(spark, sf):
    stored = inputs.vectors(spark, sf).where(F.col("label") == 3)
    return vector_search(
        stored, inputs.vector_queries(spark, sf), 5, key=("vec_id",), similarity="similarity"
    )


@query
def chunk_vectors(spark, sf):
    return vector_search(
        inputs.chunks(spark, sf), inputs.encoded_questions(spark, sf), 5, key=("doc_id", "start")
    )


@query
def ivf_assign(spark, sf):
    stored = inputs.vectors(spark, sf)
    return assign_cells(stored, label_centres(stored, "label")).select("vec_id", "cell")


@query
def ivf_topk(spark, sf):
    return ivf_search(
        inputs.label_ivf(spark, sf), inputs.vector_queries(spark, sf), 5, 3, key=("vec_id",)
    )


@query
def ivf_filtered(spark, sf):
    return ivf_search(
        inputs.label_ivf(spark, sf),
        inputs.vector_queries(spark, sf),
        5,
        key=("vec_id",),
        on=("label",),
    )


IVF_RECALL = 0.9  # share of the exact best five that the probed cells must hold
IVF_AIM = 0.95  # the share of them for half of the queries, from which nprobe is chosen


@query
def ivf_kmeans(spark, sf):
    """Trained cells: each score against the exact one, and the recall of all searches."""
    index, asked = inputs.kmeans_ivf(spark, sf), inputs.vector_queries(spark, sf)
    exact = vector_search(inputs.vectors(spark, sf), asked, 5, key=("vec_id",))
    half = F.col("query_id") % 2 == 0
    nprobe = nprobe_for(index, asked.where(half), exact.where(half), IVF_AIM, key=("vec_id",))
    found = ivf_search(index, asked, 5, nprobe=nprobe, key=("vec_id",))
    pairs = found.join(
        exact.select("query_id", "vec_id", F.lit(1).alias("best")), ["query_id", "vec_id"], "left"
    )
    stored = inputs.vectors(spark, sf).select("vec_id", F.col("vec").alias("stored"))
    cosine = 1 - cosine_distance(F.col("vec").cast("array<double>"), F.col("stored"))
    checked = pairs.join(stored, "vec_id").join(asked.select("query_id", "vec"), "query_id")
    per_query = checked.groupBy("query_id").agg(
        F.count("*").alias("hits"),
        F.bool_and(F.abs(cosine - F.col("score")) < 2e-6).alias("scores_exact"),
        F.count("best").alias("found"),
    )
    totals = per_query.agg((F.sum("found") / F.sum("hits") >= IVF_RECALL).alias("recall_reached"))
    return per_query.drop("found").crossJoin(totals)  # one row of totals


@query
def faq_vector_search(spark, sf):
    stored = inputs.faq_vectors(spark, sf)
    hits = vector_search(
        stored.where(F.col("course") == COURSE),
        inputs.encoded_questions(spark, sf),
        5,
        similarity="similarity",
    )
    return attach_payload(hits, stored, ["course", "section", "question", "answer"])


@query
def prompts_vector(spark, sf):
    stored, asked = inputs.faq_vectors(spark, sf), inputs.encoded_questions(spark, sf)
    hits = vector_search(stored, asked, 5)
    return prompt.retrieve_prompts(asked, hits, stored, prompt.faq_block())


@query
def ivf_all_cells(spark, sf):
    index = inputs.kmeans_ivf(spark, sf)
    return ivf_search(
        index, inputs.vector_queries(spark, sf), 5, nprobe=index.cells, key=("vec_id",)
    )


@query
def ivf_grown(spark, sf):
    """Exact search of an index that was built in part, grown and thinned."""
    hits, _ = bounded_search(inputs.grown_index(spark, sf), inputs.stored_queries(spark, sf))
    return hits.select("query_id", "vec_id", "score", "rank")


@query
def ivf_compacted(spark, sf):
    """The live rows of the same index after compaction."""
    return inputs.grown_index(spark, sf, compacted=True).vectors.select("vec_id", "label")


# Fusion


@query
def rank_fusion(spark, sf):
    index, asked = inputs.faq_index(spark, sf), inputs.questions(spark, sf)
    lists = [keyword_search(index, asked, 5), keyword_search(index, asked, 5, FAQ_BOOSTS)]
    return reciprocal_rank_fusion(lists, ("doc_id",))


@query
def hybrid_topk(spark, sf):
    return hybrid_search(
        inputs.chunk_index(spark, sf), inputs.chunks(spark, sf), inputs.encoded_questions(spark, sf)
    )


@query
def hit_lists(spark, sf):
    lists = both_searches(
        inputs.chunk_index(spark, sf), inputs.chunks(spark, sf), inputs.encoded_questions(spark, sf)
    )
    narrow = [hits.select("query_id", "doc_id", "rank") for hits in lists]
    return list_report(label_lists(narrow), "doc_id")


@query
def fused_names(spark, sf):
    return ranked_names(hybrid_topk(spark, sf), "doc_id")


# Prompts


@query
def context_faq(spark, sf):
    asked = inputs.questions(spark, sf)
    hits = keyword_filtered(spark, sf)
    return prompt.build_context(asked, hits, inputs.faq(spark, sf), prompt.faq_block())


@query
def context_chunks(spark, sf):
    asked, hits = inputs.questions(spark, sf), keyword_chunks(spark, sf)
    block = prompt.chunk_block("doc_id")
    return prompt.build_context(asked, hits, inputs.chunks(spark, sf), block, ("doc_id", "start"))


@query
def prompts(spark, sf):
    asked, hits = inputs.questions(spark, sf), keyword_boosted(spark, sf)
    return prompt.retrieve_prompts(asked, hits, inputs.faq(spark, sf), prompt.faq_block())


@query
def prompt_messages(spark, sf):
    asked, hits = inputs.questions(spark, sf), hybrid_topk(spark, sf)
    block = prompt.chunk_block("doc_id")
    filled = prompt.retrieve_prompts(
        asked, hits, inputs.chunks(spark, sf), block, ("doc_id", "start")
    )
    return prompt.build_messages(filled)


@query
def usage_totals(spark, sf):
    prices = spark.createDataFrame(
        [("user", 0.25e-6), ("system", 0.25e-6), ("assistant", 2e-6)], "role string, price double"
    )
    return prompt.usage_totals(inputs.table(spark, sf, "conversations"), prices)


# Message logs and tool calls


def _user_calls(spark, sf):
    """Every user turn as a call of the search tool."""
    return (
        inputs.table(spark, sf, "conversations")
        .where(F.col("role") == "user")
        .select(
            "conv_id",
            "turn",
            F.concat_ws("_", F.lit("call"), "conv_id", "turn").alias("call_id"),
            F.lit(msg.SEARCH_TOOL).alias("name"),
            F.to_json(F.struct(F.col("text").alias("query"))).alias("arguments"),
        )
    )


@query
def history_append(spark, sf):
    log = inputs.table(spark, sf, "conversations")
    new = log.where(F.col("role") == "user").select(
        "conv_id",
        F.col("turn").alias("seq"),
        F.lit("tool").alias("role"),
        F.concat(F.lit("found: "), "text").alias("text"),
    )
    return msg.append_history(log, new)


@query
def last_answer(spark, sf):
    return msg.last_answer(inputs.table(spark, sf, "conversations"))


@query
def round_count(spark, sf):
    return msg.round_count(inputs.table(spark, sf, "conversations"))


@query
def open_calls(spark, sf):
    outputs = (
        inputs.table(spark, sf, "conversations")
        .where(F.col("role") == "assistant")
        .select(F.concat_ws("_", F.lit("call"), "conv_id", F.col("turn") - 1).alias("call_id"))
    )
    return msg.open_calls(_user_calls(spark, sf), outputs).select("conv_id", "turn", "call_id")


@query
def conversation_status(spark, sf):
    log = inputs.table(spark, sf, "conversations")
    calls = log.where(
        (F.col("role") == "assistant") & (F.length("text") > 200)
    ).select("conv_id", "turn")
    return msg.conversation_status(log, calls)


@query
def tool_dispatch(spark, sf):
    index, docs = inputs.faq_index(spark, sf), inputs.faq(spark, sf)
    valid, _ = msg.check_calls(_user_calls(spark, sf))
    fields = ["course", "section", "question", "answer"]
    outputs = msg.dispatch_calls(
        valid,
        lambda asked: keyword_search(index, asked, 5, FAQ_BOOSTS, {"course": COURSE}),
        docs,
        ["doc_id", *fields],
    )
    hit = "doc_id bigint, " + ", ".join(f"{f} string" for f in fields)
    parsed = F.from_json("output", f"array<struct<{hit}>>")
    return outputs.select("call_id", "type", F.posexplode_outer(parsed).alias("pos", "h")).select(
        "call_id", "type", F.col("pos").cast("long").alias("pos"), "h.*"
    )


@query
def tool_rejects(spark, sf):
    text, turn = F.col("text"), F.col("turn")
    raw = (
        F.when(F.col("role") == "assistant", text)
        .when(turn == 0, F.to_json(F.struct(text.alias("query"))))
        .when(turn == 2, F.to_json(F.struct(text.alias("question"))))
        .when(turn == 4, F.to_json(F.struct(turn.alias("query"))))
        .otherwise(F.to_json(F.struct(text.alias("query"), turn.alias("page"))))
    )
    calls = inputs.table(spark, sf, "conversations").select(
        "conv_id",
        "turn",
        F.concat_ws("_", F.lit("call"), "conv_id", "turn").alias("call_id"),
        F.when(F.col("role") == "system", "lookup").otherwise("search").alias("name"),
        raw.alias("arguments"),
    )
    return msg.check_calls(calls)[1].select("conv_id", "turn", "call_id", "reason")


@query
def pooled_search(spark, sf):
    asked = inputs.questions(spark, sf)
    tries = F.array(
        F.struct((F.col("query_id") * 2).alias("query_id"), F.col("text").alias("text")),
        F.struct(
            (F.col("query_id") * 2 + 1).alias("query_id"),
            F.substring_index("text", "\n", 1).alias("text"),
        ),
    )
    searches = asked.select(F.inline(tries))
    hits = keyword_search(inputs.faq_index(spark, sf), searches, 5, FAQ_BOOSTS)
    return msg.pool_hits(hits.withColumn("question_id", F.floor(F.col("query_id") / 2)))
