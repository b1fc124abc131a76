"""Keyword search: a TF-IDF index kept as tables, searched by tables of queries.

Scoring is TF-IDF cosine per text field (Salton and Buckley, 1988):

* ``idf = ln((1 + N) / (1 + df)) + 1`` with the N documents of the whole index and
  ``df`` counted per field,
* a term weighs ``tf * idf``, scaled to unit length per document and field; the
  query is weighted the same way over the terms its field knows,
* ``score = sum over fields of boost * cosine``, a field without a boost counting 1,
* scores are rounded to 6 places before ranking and ties go to the smaller key;
  only positive scores are hits.

Filters remove candidates and leave the statistics alone.
"""

import math
import uuid
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from seekframe.functions.text import required, tokens
from seekframe.operators.rank import top_k
from seekframe.session import remove_path, shared_dir, spread, union_all
from seekframe.sources.tables import open_current, publish

DOCS_PER_SHARD = 16_384  # a shard is inverted and searched in memory
POSTINGS_PER_SHARD = 4_000_000  # so are long documents, of which fewer make a shard
TOKENS_AT_ONCE = 1_000_000  # counted in one block, to bound its memory
LISTS_AT_ONCE, SPELLED_AT_ONCE = 20_000, 100_000  # lists written, postings spelled out in a batch
LISTED_TERMS = 1_000  # more are joined: a predicate of that length is slow to plan
LAYOUT = "build string, key array<string>, text_fields array<string>, keyword_fields array<string>"
MATCHES_AT_ONCE = 2_000_000  # postings scored in one block, to bound its memory
PACKED_TERMS = 100_000  # asked for, from which full shards repay that lists are packed
CELLS_AT_ONCE = 2_000_000  # scores of a block of queries with all documents of a packed shard
DENSE_CELLS = 4_000_000  # of the common terms of a packed shard, kept as a matrix
LEAST_DOCS = 1_024  # of a packed shard, if there are not more tasks than cores otherwise
DENSE_SHARE = 1 / 256  # of a list's cells that match, from which it is a row of that matrix


@dataclass(frozen=True)
class KeywordIndex:
    """An index that has been written.

    ``lists`` are the postings, inverted by shards of documents: ``(shard, field, term,
    docs, counts)`` with the documents' numbers in the shard and how often each has the
    term, sorted by field and term. Two kinds of rows have the term '': one of field '' per
    shard holds the ``rows`` of its keys and keyword fields in key order, one of each text
    field the ``norms`` of its documents' weights. ``documents`` are those rows as a table.
    """

    documents: DataFrame  # *key, *keyword_fields
    lists: DataFrame
    terms: DataFrame  # field, term, df, idf
    key: tuple[str, ...]
    text_fields: tuple[str, ...]
    keyword_fields: tuple[str, ...]


def build_keyword_index(
    docs: DataFrame,
    path: str,
    text_fields: list[str],
    keyword_fields: list[str] | None = None,
    key: tuple[str, ...] = ("doc_id",),
    broadcast_terms: int = 500_000,
) -> KeywordIndex:
    """Write the index of ``docs``, whose ``key`` must be unique, below ``path`` and open it.

    Texts are read once, counted and inverted where they are read; only lists of rare terms
    and sums per document move after that. A key that occurs twice fails the build. A build
    goes to a folder of its own, which readers see when all of it is written.
    """
    spark = docs.sparkSession
    keep = [*key, *(keyword_fields or [])]
    build = f"{path}/build-{uuid.uuid4().hex}"
    words = spread(docs.select(*keep, *text_fields), *key).select(
        *keep, *[tokens(required(f)).alias(f) for f in text_fields]
    )
    _inverted(words, text_fields, key, keyword_fields or []).write.parquet(f"{build}/lists")
    lists = spark.read.parquet(f"{build}/lists")
    documents = _documents(lists)
    twice = documents.groupBy(*key).count().where("count > 1").first()
    if twice is not None:
        raise ValueError(f"key {tuple(twice)[:-1]} occurs {twice['count']} times")

    (
        lists.where(F.col("term") != "")
        .groupBy("field", "term")
        .agg(F.sum(F.size("docs")).alias("df"))
        .withColumn("idf", F.log(F.lit(1.0 + documents.count()) / (1 + F.col("df"))) + 1)
        .write.parquet(f"{build}/terms")
    )
    terms = spark.read.parquet(f"{build}/terms")
    _norms(lists, terms, broadcast_terms).write.mode("append").parquet(f"{build}/lists")
    layout = (build, list(key), list(text_fields), list(keyword_fields or []))
    publish(spark.createDataFrame([layout], LAYOUT), f"{path}/current")
    return open_keyword_index(spark, path)


def open_keyword_index(spark: SparkSession, path: str) -> KeywordIndex:
    """Open an index written earlier, by any session."""
    layout = open_current(spark, f"{path}/current").first()
    lists = spark.read.parquet(f"{layout.build}/lists")
    return KeywordIndex(
        documents=_documents(lists),
        lists=lists,
        terms=spark.read.parquet(f"{layout.build}/terms"),
        key=tuple(layout.key),
        text_fields=tuple(layout.text_fields),
        keyword_fields=tuple(layout.keyword_fields),
    )


def postings(index: KeywordIndex, broadcast_terms: int = 500_000) -> DataFrame:
    """``(*key, *keyword_fields, field, term, weight)``, one row per term of a document."""
    keep = [*index.key, *index.keyword_fields]
    schema = StructType(
        [
            *[index.documents.schema[c] for c in keep],
            StructField("field", StringType()),
            StructField("term", StringType()),
            StructField("weight", DoubleType()),
        ]
    )
    columns = ["shard", "field", "term", "docs", "counts", "norms", "rows"]
    held = index.lists.where(F.col("term") == "").select(*columns, F.lit(None).alias("idf"))
    weighed = _with_idf(index.lists, index.terms, broadcast_terms).select(
        "shard", "field", "term", "docs", "counts",
        *[F.lit(None).cast(index.lists.schema[c].dataType).alias(c) for c in ("norms", "rows")],
        "idf",
    )
    spelled = _postings_of_shard(keep, index.text_fields)
    return held.unionByName(weighed).groupBy("shard").applyInArrow(spelled, schema)


def _postings_of_shard(keep: list[str], text_fields: tuple[str, ...]):
    """Function for ``applyInArrow``: one row per term of every document of a shard."""

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        rows, norms = _shard_rows(table, text_fields)
        for name in text_fields:
            part = table.filter(pc.and_(pc.equal(table["field"], name), pc.not_equal(table["term"], "")))
            for batch in part.to_batches(max_chunksize=LISTS_AT_ONCE):
                sizes = batch["docs"].value_lengths().to_numpy(zero_copy_only=False)
                block = (np.cumsum(sizes) - 1) // SPELLED_AT_ONCE
                for own in np.split(np.arange(len(sizes)), np.flatnonzero(np.diff(block)) + 1):
                    if len(own):
                        lists = batch.slice(own[0], len(own))
                        yield _spelled_lists(lists, sizes[own], rows, norms[name], keep)

    return spelled


def _spelled_lists(lists: pa.RecordBatch, sizes, rows, norms, keep: list[str]) -> pa.RecordBatch:
    doc = lists["docs"].flatten().to_numpy(zero_copy_only=False)
    of = np.repeat(np.arange(len(sizes)), sizes)
    count = lists["counts"].flatten().to_numpy(zero_copy_only=False)
    weight = count * lists["idf"].to_numpy(zero_copy_only=False)[of] / norms[doc]
    owner, list_no = rows.take(pa.array(doc)), pa.array(of)
    return pa.RecordBatch.from_arrays(
        [
            *[owner.field(owner.type.get_field_index(c)) for c in keep],
            lists["field"].take(list_no),
            lists["term"].take(list_no),
            pa.array(weight),
        ],
        names=[*keep, "field", "term", "weight"],
    )


def keyword_search(
    index: KeywordIndex,
    queries: DataFrame,
    num_results: int = 5,
    boosts: Mapping[str, float] | None = None,
    filters: Mapping[str, object] | None = None,
    match: tuple[str, ...] = (),
    slice_terms: int = 2_000_000,
) -> DataFrame:
    """``(query_id, *key, score, rank)``: the best documents for each ``(query_id, text)``.

    ``filters`` maps keyword fields to one value for all queries; ``match`` names
    keyword fields that must equal the query's own column of that name.

    Only the lists of terms that some query asks for are read; they meet in their shard,
    are scored there in Arrow batches and leave it as the best k per query. A word that a
    third of the documents share is split over all shards.

    Query tables with more than ``slice_terms`` terms go out in slices, one after the other.
    For these, and from ``PACKED_TERMS`` on, the lists move once, cut to the documents that pass
    the filters and packed to full shards in the shared folder, and the hits of each slice are
    appended to a table there.
    """
    boosts = dict(boosts or {})
    unknown = set(boosts) - set(index.text_fields)
    if unknown:
        raise ValueError(f"boost for unknown text field: {sorted(unknown)}")
    not_keyword = (set(filters or {}) | set(match)) - set(index.keyword_fields)
    if not_keyword:
        raise ValueError(f"filter on a field that is not a keyword: {sorted(not_keyword)}")

    schema = StructType(
        [
            queries.schema["query_id"],
            *[index.documents.schema[k] for k in index.key],
            StructField("score", DoubleType()),
        ]
    )
    distinct = F.size(F.array_distinct(tokens(F.col("text"))))
    n_terms = queries.agg(F.sum(distinct)).first()[0] or 0
    order = [F.desc("score"), *map(F.asc, index.key)]
    size = n_terms * len(index.text_fields)
    if size > min(slice_terms, PACKED_TERMS):
        n = math.ceil(size / slice_terms)
        best = lambda hits: top_k(hits, num_results, order)
        kept = dict(filters or {})
        return _search_slices(index, queries, n, boosts, kept, match, num_results, schema, best)
    weights = _query_weights(index, queries, boosts, match).toArrow()
    shared = index.lists.sparkSession.sparkContext.broadcast(
        _query_matrix(weights, index.text_fields, match)
    )
    asked = _asked_lists(index, queries, weights)
    best = _best_of_shard(
        shared, index.key, index.text_fields, dict(filters or {}), match, num_results
    )
    return top_k(asked.groupBy("shard").applyInArrow(best, schema), num_results, order)


def _search_slices(
    index: KeywordIndex,
    queries: DataFrame,
    n: int,
    boosts: Mapping[str, float],
    filters: dict[str, object],
    match: tuple[str, ...],
    k: int,
    schema: StructType,
    best: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """The ``best`` hits of ``n`` slices of the queries, searched one after the other.

    Queries are written once by slice and lists once as packed shards, so neither moves again
    for every slice; only one slice is broadcast at a time.
    """
    spark = index.lists.sparkSession
    place = f"{shared_dir(spark)}/search-{uuid.uuid4().hex}"
    part = F.pmod(F.xxhash64("query_id"), F.lit(n)).cast("int").alias("_slice")
    cut = queries.select("query_id", *match, "text", part).repartition(n, "_slice")
    cut.write.partitionBy("_slice").parquet(f"{place}/queries")
    _packed(index, filters).write.option("maxRecordsPerFile", 1).parquet(f"{place}/shards")
    asked, shards = spark.read.parquet(f"{place}/queries"), spark.read.parquet(f"{place}/shards")
    for i in range(n):
        own = asked.where(F.col("_slice") == i).drop("_slice")
        weights = _query_weights(index, own, boosts, match).toArrow()
        shared = spark.sparkContext.broadcast(_query_matrix(weights, index.text_fields, match))
        scored = shards.mapInArrow(
            _best_of_packed(shared, index.key, index.text_fields, match, k), schema
        )
        best(scored).write.mode("append").parquet(f"{place}/hits")
        shared.destroy()
    for done in ("queries", "shards"):
        remove_path(spark, f"{place}/{done}")
    return spark.read.parquet(f"{place}/hits")


def _packed(index: KeywordIndex, filters: dict[str, object]) -> DataFrame:
    """``(lists, rows)``: the documents that pass the filters in full shards, a row for each.

    A filter may leave little of every shard. What is left moves once, into shards of at most
    ``DOCS_PER_SHARD`` documents and ``POSTINGS_PER_SHARD`` postings or what was one shard.
    """
    lists, context = index.lists, index.lists.sparkSession.sparkContext
    flags = lists.where(F.col("field") == "").mapInArrow(
        _flags_of_shard(filters), "shard long, size int, docs int, flags binary"
    )
    found = flags.where("docs > 0").toArrow().to_pylist()
    kept = {r["shard"]: (0, r["size"], r["flags"]) for r in found}
    counted = (
        lists.where(F.col("term") != "")
        .select("shard", "docs")
        .mapInArrow(_postings_left(context.broadcast(kept)), "shard long, postings long")
        .groupBy("shard")
        .agg(F.sum("postings"))
    )
    left = dict(map(tuple, counted.collect()))
    most = min(DOCS_PER_SHARD, max(LEAST_DOCS, -(-sum(r["docs"] for r in found) // context.defaultParallelism)))
    group, docs, postings = 0, 0, 0
    for r in sorted(found, key=lambda r: r["shard"]):
        n = left.get(r["shard"], 0)
        if docs and (docs + r["docs"] > most or postings + n > POSTINGS_PER_SHARD):
            group, docs, postings = group + 1, 0, 0
        docs, postings = docs + r["docs"], postings + n
        kept[r["shard"]] = (group, *kept[r["shard"]][1:])
    shared, moved = context.broadcast(kept), "pack long, shard long, kind string, data binary"
    # Apart: columns of arrays that are null in nearly all rows are slow to read.
    held = lists.where(F.col("term") == "").mapInArrow(_left_of_heads(shared), moved)
    cut = lists.where(F.col("term") != "").select("shard", "field", "term", "docs", "counts")
    pack = _pack([*index.key, *index.keyword_fields], index.key, index.text_fields)
    return (
        held.unionByName(cut.mapInArrow(_left_of_lists(shared), moved))
        .groupBy("pack")
        .applyInArrow(pack, "lists binary, rows binary")
    )


def _flags_of_shard(filters: dict[str, object]):
    """Function for ``mapInArrow``: how many documents a shard has, how many and which pass."""

    def flags(batches):
        for batch in batches:
            good = [_allowed(rows.values, filters) for rows in batch["rows"]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["shard"],
                    pa.array([len(g) for g in good], pa.int32()),
                    pa.array([g.sum() for g in good], pa.int32()),
                    pa.array([np.packbits(g).tobytes() for g in good], pa.binary()),
                ],
                names=["shard", "size", "docs", "flags"],
            )

    return flags


def _by_shard(batches, kept):
    """Shard, pack, the flags of its documents and its rows, for shards that have any left."""
    for batch in batches:
        for number in pc.unique(batch["shard"]).to_pylist():
            if number in kept:
                pack, size, flags = kept[number]
                good = np.unpackbits(np.frombuffer(flags, np.uint8), count=size).astype(bool)
                yield number, pack, good, batch.filter(pc.equal(batch["shard"], number))


def _postings_left(shared):
    """Function for ``mapInArrow``: how many postings of a shard a filter leaves."""

    def count(batches):
        for number, _, good, own in _by_shard(batches, shared.value):
            left = int(good[own["docs"].flatten().to_numpy(zero_copy_only=False)].sum())
            yield pa.RecordBatch.from_pydict({"shard": [number], "postings": [left]})

    return count


def _left(own: pa.RecordBatch, good, values: str, *columns: str) -> pa.RecordBatch:
    """The documents of lists that are left, numbered among these, with ``values`` of each."""
    size = own["docs"].value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    doc = own["docs"].flatten().to_numpy(zero_copy_only=False)
    stays = good[doc]
    of = np.repeat(np.arange(len(size)), size)[stays]
    ends = pa.array(np.append(0, np.cumsum(np.bincount(of, minlength=len(size)))), pa.int32())
    docs = pa.ListArray.from_arrays(ends, pa.array((np.cumsum(good) - 1)[doc[stays]], pa.int32()))
    held = pa.ListArray.from_arrays(ends, own[values].flatten().filter(pa.array(stays)))
    out = pa.RecordBatch.from_arrays(
        [*[own[c] for c in columns], docs, held], names=[*columns, "docs", values]
    )
    return out.filter(pc.greater(pc.list_value_length(docs), 0))


def _left_of_lists(shared):
    """Function for ``mapInArrow``: the lists of the documents that are left."""

    def left(batches):
        for number, pack, good, own in _by_shard(batches, shared.value):
            yield _parcel(pack, number, "lists", _left(own, good, "counts", "field", "term"))

    return left


def _left_of_heads(shared):
    """Function for ``mapInArrow``: rows and norms of the documents that are left."""

    def left(batches):
        for number, pack, good, own in _by_shard(batches, shared.value):
            head = pc.equal(own["field"], "")
            normed = own.filter(pc.invert(head))
            if normed.num_rows:
                yield _parcel(pack, number, "norms", _left(normed, good, "norms", "field"))
            for rows in own["rows"].filter(head):
                stays = pa.RecordBatch.from_struct_array(rows.values.filter(pa.array(good)))
                yield _parcel(pack, number, "rows", stays)

    return left


def _parcel(pack: int, shard: int, kind: str, part: pa.RecordBatch) -> pa.RecordBatch:
    """Part of a shard as one row."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([pack], pa.int64()),
            pa.array([shard], pa.int64()),
            pa.array([kind], pa.string()),
            pa.array([_stream([part], part.schema)], pa.binary()),
        ],
        names=["pack", "shard", "kind", "data"],
    )


def _stream(batches: list[pa.RecordBatch], schema: pa.Schema) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        for batch in batches:
            out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _pack(columns: list[str], key: tuple[str, ...], text_fields: tuple[str, ...]):
    """Function for ``applyInArrow``: what is left of some shards as one, in two Arrow streams.

    ``lists`` are ``(field, term, docs, counts)``; ``rows`` the documents in key order, with
    their norms by number of the text field.
    """
    numbered = pa.list_(pa.int32())
    schema = pa.schema(
        [("field", pa.string()), ("term", pa.string()), ("docs", numbered), ("counts", numbered)]
    )

    def pack(table: pa.Table) -> pa.Table:
        parts: dict[str, list[tuple[int, pa.Table]]] = {"rows": [], "norms": [], "lists": []}
        for number, kind, data in zip(table["shard"].to_pylist(), table["kind"].to_pylist(), table["data"]):
            parts[kind].append((number, pa.ipc.open_stream(data.as_buffer()).read_all()))
        heads = sorted(parts["rows"], key=lambda x: x[0])
        ends = np.cumsum([part.num_rows for _, part in heads])
        first = {number: end - part.num_rows for (number, part), end in zip(heads, ends)}
        rows = pa.concat_tables([part for _, part in heads]).select(columns)
        order = pc.sort_indices(rows, [(c, "ascending") for c in key])
        rank = np.empty(len(rows), np.int32)
        rank[order.to_numpy()] = np.arange(len(rows), dtype=np.int32)
        rows = rows.take(order)

        def joined(kind: str, field: str, values: str):
            """Rows of all parts, the row of each document in them, its number and value."""
            own = [(n, part.filter(pc.equal(part["field"], field))) for n, part in parts[kind]]
            own = [(n, part) for n, part in own if part.num_rows]
            if not own:
                return None
            whole = pa.concat_tables([part for _, part in own])
            start = np.repeat([first[n] for n, _ in own], [part.num_rows for _, part in own])
            size = pc.list_value_length(whole["docs"]).to_numpy()
            of = np.repeat(np.arange(len(size)), size)
            doc, value = (whole[c].combine_chunks().flatten().to_numpy() for c in ("docs", values))
            return whole, of, rank[start[of] + doc], value

        merged = []
        for i, name in enumerate(text_fields):
            norms = np.ones(len(rows))
            if held := joined("norms", name, "norms"):
                norms[held[2]] = held[3]
            rows = rows.append_column(f"norm {i}", pa.array(norms))
            if held := joined("lists", name, "counts"):
                whole, of, doc, counts = held
                terms = _whole(whole["term"]).dictionary_encode()
                code = terms.indices.to_numpy()[of]
                by_term = np.lexsort((doc, code))
                ends = np.searchsorted(code[by_term], np.arange(len(terms.dictionary) + 1))
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x[by_term], pa.int32()))
                    for x in (doc, counts)
                ]
                fields = pa.array([name] * len(terms.dictionary), pa.string())
                merged.append(pa.RecordBatch.from_arrays([fields, terms.dictionary, *lists], schema=schema))
        held_rows = _stream(rows.combine_chunks().to_batches(), rows.schema)
        return pa.table(
            [pa.array([x], pa.binary()) for x in (_stream(merged, schema), held_rows)],
            names=["lists", "rows"],
        )

    return pack


def _best_of_packed(
    shared, key: tuple[str, ...], text_fields: tuple[str, ...], match: tuple[str, ...], k: int
):
    """Function for ``mapInArrow``: score packed shards, keep the best k of each per query."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, wanted, by_field = shared.value
        groups = {value: i for i, value in enumerate(dict.fromkeys(wanted))}
        asked_group = np.array([groups[value] for value in wanted], np.int64)
        for batch in batches:
            for packed in zip(batch["lists"], batch["rows"]):
                lists, rows = (pa.ipc.open_stream(p.as_buffer()).read_all() for p in packed)
                n = rows.num_rows
                norms = {f: rows[f"norm {i}"].to_numpy() for i, f in enumerate(text_fields)}
                held = _entries(lists, text_fields, by_field, norms, np.ones(n, bool))
                if match:
                    values = zip(*[rows[c].to_pylist() for c in match])
                    row_group = np.array([groups.get(v, -1) for v in values], np.int64)
                for query, cells in _score_blocks(*held, n):
                    if match:
                        cells[asked_group[query][:, None] != row_group] = 0
                    row, place, value = _best_cells(cells, k)
                    taken = rows.select(key).take(pa.array(place)).combine_chunks()
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(query[row])),
                            *[_whole(taken[c]) for c in key],
                            pa.array(value),
                        ],
                        names=["query_id", *key, "score"],
                    )

    return best


def _whole(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    return whole if isinstance(whole, pa.Array) else pa.concat_arrays(whole.chunks)


def _score_blocks(lists, entries, n: int):
    """(queries, their scores with all ``n`` documents), in blocks of bounded size.

    Lists that many of the queries ask for and many of the documents are in are multiplied as
    a matrix; the matches of the others are summed one by one.
    """
    docs, shares, starts, sizes = lists
    query, number, weight = entries
    if not len(query):
        return
    new = np.concatenate(([True], query[1:] != query[:-1]))
    opens, row = np.append(np.flatnonzero(new), len(query)), np.cumsum(new) - 1
    rows = len(opens) - 1
    share = np.bincount(number, minlength=len(sizes)) / rows * sizes / n
    common = np.argsort(-share, kind="stable")[: max(1, DENSE_CELLS // n)]
    common = common[share[common] >= DENSE_SHARE]
    column = np.full(len(sizes), -1)
    column[common] = np.arange(len(common))
    matrix = np.zeros((len(common), n))
    for i, at in enumerate(common):
        own = slice(starts[at], starts[at] + sizes[at])
        matrix[i, docs[own]] = shares[own]
    dense = column[number] >= 0
    ends = np.cumsum(np.bincount(row, weights=np.where(dense, 0, sizes[number]), minlength=rows))
    low = 0
    while low < rows:
        before = ends[low - 1] if low else 0
        high = int(np.searchsorted(ends, before + MATCHES_AT_ONCE, side="right"))
        high = min(max(high, low + 1), low + max(1, CELLS_AT_ONCE // n), rows)
        own = slice(opens[low], opens[high])
        line, list_no, factor, many = row[own] - low, number[own], weight[own], dense[own]
        held = np.zeros((high - low, len(common)))
        held[line[many], column[list_no[many]]] = factor[many]
        cells = held @ matrix
        line, list_no, factor = line[~many], list_no[~many], factor[~many]
        times = sizes[list_no]
        at = np.repeat(starts[list_no] - np.cumsum(times) + times, times) + np.arange(times.sum())
        cell = np.repeat(line * n, times) + docs[at]
        value = np.repeat(factor, times) * shares[at]
        cells += np.bincount(cell, weights=value, minlength=cells.size).reshape(cells.shape)
        yield query[opens[low:high]], cells
        low = high


def _best_cells(cells, k: int, width: int = 64):
    """(row, place, score) of the best ``k`` positive cells of each row, rounded, best first.

    The k-th of the maxima of runs of cells bounds the k-th cell from below, so that few
    cells are rounded and sorted.
    """
    rows, n = cells.shape
    least, runs = np.zeros(rows), n // width
    if runs > k:
        maxima = cells[:, : runs * width].reshape(rows, runs, width).max(axis=2)
        least = np.partition(maxima, runs - k, axis=1)[:, runs - k]
    found = np.flatnonzero(cells >= np.maximum(least - 2e-6, 4e-7)[:, None])
    row, place, value = found // n, found % n, np.round(cells.ravel()[found], 6)
    order = np.lexsort((place, -value, row))
    order = order[value[order] > 0]
    row, place, value = row[order], place[order], value[order]
    near = np.arange(len(row)) - np.searchsorted(row, row) < k
    return row[near], place[near], value[near]


def _asked_lists(index: KeywordIndex, part: DataFrame, weights: pa.Table) -> DataFrame:
    """The lists of all terms that ``part`` asks for, and the rows of every shard.

    The term reaches the scan as a predicate, or as a join with the terms of the queries,
    which are one slice at most.
    """
    terms = pc.unique(weights["term"]).to_pylist()
    if len(terms) <= LISTED_TERMS:
        return index.lists.where(F.col("term").isin([*terms, ""]))
    wanted = part.select(F.explode(F.concat(tokens(F.col("text")), F.array(F.lit("")))).alias("term"))
    return index.lists.join(F.broadcast(wanted.distinct()), "term", "left_semi")


def _documents(lists: DataFrame) -> DataFrame:
    """``(*key, *keyword_fields)`` of all shards."""
    return lists.where(F.col("field") == "").select(F.inline("rows"))


def _inverted(
    words: DataFrame, text_fields: list[str], key: tuple[str, ...], keyword_fields: list[str]
) -> DataFrame:
    """Lists of the terms of every shard of documents, whose fields are arrays of tokens.

    A shard is a run of documents that one task reads, so no text and no posting moves. It
    ends with ``DOCS_PER_SHARD`` documents or ``POSTINGS_PER_SHARD`` postings.
    """
    columns = [*key, *keyword_fields]
    row = StructType([words.schema[c] for c in columns])
    schema = StructType(
        [
            StructField("shard", LongType()),
            StructField("field", StringType()),
            StructField("term", StringType()),
            StructField("docs", ArrayType(IntegerType())),
            StructField("counts", ArrayType(IntegerType())),
            StructField("norms", ArrayType(DoubleType())),
            StructField("rows", ArrayType(row)),
        ]
    )
    most_docs, most_postings, most_tokens = DOCS_PER_SHARD, POSTINGS_PER_SHARD, TOKENS_AT_ONCE

    def invert(batches):
        number = TaskContext.get().partitionId() << 32
        held, counted, n, postings = [], {f: [] for f in text_fields}, 0, 0
        for batch in batches:
            for block in _blocks(batch, text_fields, most_docs, most_tokens):
                held.append(block.select(columns))
                for f in text_fields:
                    doc, code, tf, names = _counted(block[f])
                    counted[f].append((doc + n, code, tf, names))
                    postings += len(doc)
                n += block.num_rows
                if n >= most_docs or postings >= most_postings:
                    yield from _shard_batches(number, held, counted, key)
                    number += 1
                    held, counted, n, postings = [], {f: [] for f in text_fields}, 0, 0
        if n:
            yield from _shard_batches(number, held, counted, key)

    return words.mapInArrow(invert, schema)


def _blocks(batch: pa.RecordBatch, text_fields: list[str], most_docs: int, most_tokens: int):
    """Runs of rows of a batch with at most ``most_tokens`` tokens, or of one row."""
    if batch.num_rows == 0:
        return
    sizes = sum(
        batch[f].value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for f in text_fields
    )
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start] - sizes[start]
        stop = int(np.searchsorted(ends, before + most_tokens, side="right"))
        stop = min(max(stop, start + 1), start + most_docs)
        yield batch.slice(start, stop - start)
        start = stop


def _counted(lists):
    """(row, code, count) of the distinct tokens of arrays of tokens, and the tokens by code."""
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), sizes)
    encoded = lists.flatten().dictionary_encode()
    width = max(1, len(encoded.dictionary))
    code = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    pairs, tf = np.unique(row * width + code, return_counts=True)
    doc, code = (pairs // width).astype(np.int32), (pairs % width).astype(np.int32)
    return doc, code, tf.astype(np.int32), encoded.dictionary


def _shard_batches(number: int, held, counted, key: tuple[str, ...]):
    """The rows of one shard: its documents in key order, and the lists of its fields."""
    table = pa.Table.from_batches(held)
    order = pc.sort_indices(table, [(c, "ascending") for c in key])
    rank = np.empty(table.num_rows, np.int32)
    rank[order.to_numpy()] = np.arange(table.num_rows)
    table = table.take(order).combine_chunks()
    rows = pa.StructArray.from_arrays(
        [table[c].combine_chunks() for c in table.column_names], fields=list(table.schema)
    )
    held_rows = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
    head = _lists_batch(number, "", pa.array([""]), np.zeros(2), [], [], held_rows)
    yield head
    for field, blocks in counted.items():
        encoded = pa.chunked_array([names for *_, names in blocks], pa.string())
        encoded = encoded.combine_chunks().dictionary_encode()
        names = encoded.dictionary
        sorted_names = pc.sort_indices(names)
        place = np.empty(len(names), np.int32)
        place[sorted_names.to_numpy()] = np.arange(len(names), dtype=np.int32)
        place = place[encoded.indices.to_numpy(zero_copy_only=False)]
        offsets = np.cumsum([0, *[len(names) for *_, names in blocks]])
        code = np.concatenate([place[at + c] for at, (_, c, _, _) in zip(offsets, blocks)])
        doc = rank[np.concatenate([d for d, *_ in blocks])]
        by_term = np.lexsort((doc, code))
        ends = np.searchsorted(code[by_term], np.arange(len(names) + 1))
        tf = np.concatenate([t for _, _, t, _ in blocks])[by_term]
        batch = _lists_batch(
            number, field, names.take(sorted_names), ends, doc[by_term], tf,
            pa.nulls(len(names), held_rows.type),
        )
        for at in range(0, batch.num_rows, LISTS_AT_ONCE):
            yield batch.slice(at, LISTS_AT_ONCE)


def _lists_batch(number: int, field: str, terms, ends, docs, counts, rows) -> pa.RecordBatch:
    ends = pa.array(np.asarray(ends, np.int32))
    n = len(terms)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, number, np.int64)),
            pa.array([field] * n, pa.string()),
            terms,
            pa.ListArray.from_arrays(ends, pa.array(np.asarray(docs, np.int32))),
            pa.ListArray.from_arrays(ends, pa.array(np.asarray(counts, np.int32))),
            pa.nulls(n, pa.list_(pa.float64())),
            rows,
        ],
        names=["shard", "field", "term", "docs", "counts", "norms", "rows"],
    )


def _by_frequency(terms: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """``(field, term, idf)`` of the common terms, to broadcast, and of the rare ones.

    Document frequencies add up to the number of postings P, so at most ``limit``
    terms can have ``df >= P / limit``, whatever the corpus. A term below that bound has
    few postings, so joining the rare ones by term has no hot key. When the whole
    vocabulary is within ``limit`` there are no rare terms.
    """
    n_terms, n_postings = terms.agg(F.count("*"), F.sum("df")).first()
    idf = terms.select("field", "term", "idf")
    if n_terms <= limit:
        return F.broadcast(idf), None
    common = F.col("df") >= -(-n_postings // limit)
    named = ["field", "term", "idf"]
    return F.broadcast(terms.where(common).select(named)), terms.where(~common).select(named)


def _with_idf(lists: DataFrame, terms: DataFrame, limit: int) -> DataFrame:
    """``(shard, field, term, docs, counts, idf)``; only lists of rare terms move."""
    named = lists.where(F.col("term") != "").select("shard", "field", "term", "docs", "counts")
    common, rare = _by_frequency(terms, limit)
    parts = [named.join(common, ["field", "term"])]
    if rare is not None:
        rest = named.join(common.drop("idf"), ["field", "term"], "left_anti")
        parts.append(rest.join(rare, ["field", "term"]))
    return union_all(parts)


def _norms(lists: DataFrame, terms: DataFrame, limit: int) -> DataFrame:
    """The rows of ``norms``: per shard and field the roots of the summed ``(tf * idf)^2``.

    Squares are summed where the lists lie, and again by document; documents do not move.
    """
    weight = F.col("counts") * F.col("idf")
    per_document = (
        _with_idf(lists, terms, limit)
        .select("shard", "field", "idf", F.inline(F.arrays_zip("docs", "counts")))
        .groupBy("shard", "field", "docs")
        .agg(F.sqrt(F.sum(weight * weight)).alias("norms"))
    )
    listed = F.array_sort(F.collect_list(F.struct("docs", "norms")))
    none = {c: F.lit(None).cast(lists.schema[c].dataType) for c in ("counts", "rows")}
    return (
        per_document.groupBy("shard", "field")
        .agg(listed.alias("z"))
        .select("shard", "field", F.lit("").alias("term"), "z.docs", "z.norms")
        .withColumns(none)
        .select(*lists.columns)
    )


def _query_weights(
    index: KeywordIndex, queries: DataFrame, boosts: Mapping[str, float], match: tuple[str, ...]
) -> DataFrame:
    """``(query_id, *match, field, term, query_weight)``.

    The weight takes in the boost, the query norm and the idf of the document's side, so
    that a document adds ``query_weight * tf / norm``.
    """
    tf = (
        queries.dropna(subset=list(match))
        .select("query_id", *match, F.explode(tokens(F.col("text"))).alias("term"))
        .groupBy("query_id", *match, "term")
        .agg(F.count("*").alias("tf"))
    )
    raw = F.col("tf") * F.col("idf")
    per_query = Window.partitionBy("query_id", *match, "field")
    boost: Column = F.lit(1.0)
    for field, factor in boosts.items():
        boost = F.when(F.col("field") == field, F.lit(float(factor))).otherwise(boost)
    weight = boost * raw / F.sqrt(F.sum(raw * raw).over(per_query)) * F.col("idf")
    return (
        index.terms.join(F.broadcast(tf), "term")
        .select("query_id", *match, "field", "term", weight.alias("query_weight"))
    )


def _query_matrix(weights, text_fields: tuple[str, ...], match: tuple[str, ...]):
    """Query ids, match values, and per field the terms with the queries that hold them."""
    columns = [weights[c].combine_chunks() for c in ["query_id", *match]]
    codes = [c.dictionary_encode(null_encoding="encode").indices.to_numpy() for c in columns]
    _, first, query = np.unique(codes, axis=1, return_index=True, return_inverse=True)
    query = query.reshape(-1).astype(np.int64)
    asked = [c.take(pa.array(first)) for c in columns]
    values = list(zip(*[c.to_pylist() for c in asked[1:]])) if match else [()] * len(first)
    by_field = {}
    for f in text_fields:
        mask = pc.equal(weights["field"], f)
        encoded = weights["term"].filter(mask).combine_chunks().dictionary_encode()
        code = encoded.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(code, kind="stable")
        starts = np.searchsorted(code[order], np.arange(len(encoded.dictionary) + 1))
        rows = mask.to_numpy(zero_copy_only=False) if len(mask) else np.empty(0, bool)
        weight = weights["query_weight"].to_numpy()[rows]
        by_field[f] = (encoded.dictionary, starts, query[rows][order], weight[order])
    return asked[0], values, by_field


def _best_of_shard(
    shared,
    key: tuple[str, ...],
    text_fields: tuple[str, ...],
    filters: dict[str, object],
    match: tuple[str, ...],
    k: int,
):
    """Function for ``applyInArrow``: score the asked lists of a shard, keep the best k."""

    def best(table: pa.Table) -> pa.Table:
        ids, wanted, by_field = shared.value
        rows, norms = _shard_rows(table, text_fields)
        allowed = _allowed(rows, filters)
        groups = {value: i for i, value in enumerate(dict.fromkeys(wanted))}
        asked_group = np.array([groups[value] for value in wanted], np.int64)
        if match:
            values = zip(*[rows.field(rows.type.get_field_index(c)).to_pylist() for c in match])
            row_group = np.array([groups.get(v, -1) for v in values], np.int64)
            allowed &= row_group >= 0
            row_group = row_group[allowed]
        # What a filter removes is never scored.
        rows = rows.filter(pa.array(allowed))
        n = len(rows)
        lists, entries = _entries(table, text_fields, by_field, norms, allowed)
        owner, score, doc = [np.empty(0, np.int64)], [np.empty(0)], [np.empty(0, np.int64)]
        for query, place, value in _scores(lists, entries, n):
            good = value > 0
            if match:
                good &= row_group[place] == asked_group[query]
            query, place, value = query[good], place[good], value[good]
            order = np.lexsort((place, -value, query))
            query, place, value = query[order], place[order], value[order]
            first = np.searchsorted(query, query)
            near = np.arange(len(query)) - first < k
            owner.append(query[near])
            score.append(value[near])
            doc.append(place[near])
        taken = rows.take(pa.array(np.concatenate(doc)))
        return pa.table(
            [
                ids.take(pa.array(np.concatenate(owner))),
                *[taken.field(taken.type.get_field_index(c)) for c in key],
                pa.array(np.concatenate(score)),
            ],
            names=["query_id", *key, "score"],
        )

    return best


def _allowed(rows, filters: dict[str, object]):
    """Which of the documents pass the filters."""
    allowed = np.ones(len(rows), bool)
    for name, value in filters.items():
        column = rows.field(rows.type.get_field_index(name))
        equal = pc.equal(column, pa.scalar(value, column.type))
        allowed &= equal.fill_null(False).to_numpy(zero_copy_only=False)
    return allowed


def _shard_rows(table: pa.Table, text_fields: tuple[str, ...]):
    """Keys and keyword fields of a shard's documents, and by field the norms of their weights."""
    held = table.filter(pc.equal(table["term"], ""))
    rows = held.filter(pc.equal(held["field"], ""))["rows"].combine_chunks().flatten()
    norms = {}
    for name in text_fields:
        part = held.filter(pc.equal(held["field"], name))
        norms[name] = np.ones(len(rows))
        docs = part["docs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        norms[name][docs] = part["norms"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return rows, norms


def _entries(table: pa.Table, text_fields: tuple[str, ...], by_field, norms, allowed):
    """Lists of a shard end to end, and the (query, list, weight) that ask for them by query.

    The lists hold ``allowed`` documents only, numbered from 0 among these.
    """
    place = np.cumsum(allowed) - 1
    docs, shares, starts, sizes = [], [], [], []
    query, number, weight = [], [], []
    total = lists = 0
    for name in text_fields:
        part = table.filter(pc.equal(table["field"], name)).combine_chunks()
        if part.num_rows == 0:
            continue
        vocabulary, ends, queries, weights = by_field[name]
        code = pc.index_in(part["term"].combine_chunks(), value_set=vocabulary)
        part = part.filter(code.is_valid())
        code = code.drop_null().to_numpy(zero_copy_only=False)
        size = pc.list_value_length(part["docs"]).to_numpy()
        doc = part["docs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        share = part["counts"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        good = allowed[doc]
        size = np.bincount(np.repeat(np.arange(len(size)), size)[good], minlength=len(size))
        doc, share = doc[good], share[good]
        code, size = code[size > 0], size[size > 0]
        docs.append(place[doc])
        shares.append(share / norms[name][doc])
        starts.append(total + np.cumsum(size) - size)
        sizes.append(size)
        times = ends[code + 1] - ends[code]
        at = np.repeat(ends[code] - np.cumsum(times) + times, times) + np.arange(times.sum())
        query.append(queries[at])
        weight.append(weights[at])
        number.append(lists + np.repeat(np.arange(len(code)), times))
        total += int(size.sum())
        lists += len(code)

    def joined(parts, kind):
        return np.concatenate([np.empty(0, kind), *parts]).astype(kind)

    query = joined(query, np.int64)
    order = np.argsort(query, kind="stable")
    held = joined(docs, np.int64), joined(shares, float), joined(starts, np.int64), joined(sizes, np.int64)
    return held, (query[order], joined(number, np.int64)[order], joined(weight, float)[order])


def _scores(lists, entries, n: int):
    """(query, document, score) of all pairs that share a term, in blocks of whole queries.

    A block with few matches is summed by sorting its cells, one with many in an array of
    all its cells; either costs in step with the matches.
    """
    docs, shares, starts, sizes = lists
    query, number, weight = entries
    if not len(query):
        return
    opens = np.flatnonzero(np.concatenate(([True], query[1:] != query[:-1])))
    load = np.add.reduceat(sizes[number], opens)
    block = (np.cumsum(load) - 1) // MATCHES_AT_ONCE
    for b in np.unique(block):
        own = np.flatnonzero(block == b)
        low = opens[own[0]]
        high = opens[own[-1] + 1] if own[-1] + 1 < len(opens) else len(query)
        times = sizes[number[low:high]]
        first = starts[number[low:high]] - np.cumsum(times) + times
        at = np.repeat(first, times) + np.arange(times.sum())
        asked = query[opens[own]]
        row = np.repeat(np.searchsorted(asked, query[low:high]), times)
        value = np.repeat(weight[low:high], times) * shares[at]
        cell = row * n + docs[at]
        if len(asked) * n <= 4 * len(cell):
            summed = np.bincount(cell, weights=value, minlength=len(asked) * n)
            found = np.flatnonzero(summed)
            total = summed[found]
        else:
            found, inverse = np.unique(cell, return_inverse=True)
            total = np.bincount(inverse, weights=value)
        yield asked[found // n], found % n, np.round(total, 6)
