"""Message logs and tool calls as tables: one round of an assistant for all conversations.

A log is ``(conv_id, turn, role, text)``; calls are ``(call_id, name, arguments)`` with
the arguments as JSON text; outputs are ``(call_id, type, output)``.
"""

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.operators.rank import dense_number, top_k
from seekframe.session import shared_dir

# The names of the tool, its argument and the item types.
SEARCH_TOOL = "search"
QUERY_ARGUMENT = "query"
OUTPUT_TYPE = "function_call_output"
MODEL_ROLE = "assistant"

LISTED_KEYS = 500_000  # of records with a hit: up to here they are broadcast to thin the records
HITS_AT_ONCE = 8_192  # whose records one task puts together


def append_history(log: DataFrame, new: DataFrame) -> DataFrame:
    """Log with the ``new(conv_id, seq, role, text)`` items behind it, in ``seq`` order.

    ``seq`` is a whole number, unique within its conversation. Turns go on from the
    last turn of the conversation, or start at 0.
    """
    first = log.groupBy("conv_id").agg((F.max("turn") + 1).alias("first"))
    numbered = dense_number(new, "conv_id", "seq", first, "turn")
    columns = ["conv_id", "turn", "role", "text"]
    return log.select(*columns).unionByName(numbered.select(*columns))


def reject_reason(name: Column, arguments: Column, tool: str = SEARCH_TOOL) -> Column:
    """Why a call cannot be run; NULL for a call that can."""
    keys = F.json_object_keys(arguments)
    parsed = F.try_parse_json(arguments)
    query = F.try_variant_get(parsed, f"$.{QUERY_ARGUMENT}", "variant")
    extra = F.size(F.array_remove(keys, QUERY_ARGUMENT)) > 0
    return (
        F.when(F.coalesce(name != tool, F.lit(True)), "unknown tool")
        .when(keys.isNull() | parsed.isNull(), "malformed arguments")
        .when(~F.array_contains(keys, QUERY_ARGUMENT), "missing query")
        .when(F.coalesce(F.schema_of_variant(query) != "STRING", F.lit(True)), "query not a string")
        .when(extra, "unexpected argument")
    )


def check_calls(calls: DataFrame, tool: str = SEARCH_TOOL) -> tuple[DataFrame, DataFrame]:
    """Calls that can be run, with their ``query``; and the rest, with a ``reason``."""
    checked = calls.withColumn("reason", reject_reason(F.col("name"), F.col("arguments"), tool))
    parsed = F.from_json("arguments", f"{QUERY_ARGUMENT} string")[QUERY_ARGUMENT]
    valid = checked.where(F.col("reason").isNull()).drop("reason").withColumn("query", parsed)
    return valid, checked.where(F.col("reason").isNotNull())


def dispatch_calls(
    calls: DataFrame,
    search: Callable[[DataFrame], DataFrame],
    docs: DataFrame,
    payload: list[str],
    key: tuple[str, ...] = ("doc_id",),
    pretty: bool = True,
) -> DataFrame:
    """``(call_id, type, output)`` for all valid ``calls``, answered by one search job.

    ``search`` maps ``(query_id, text)`` to hits. The output is a JSON array of the
    ``payload`` of the hits, best first, empty if there are none.

    The hits are stored first: they are small, and known by number before any record moves.
    Records without a hit stay where they are; the others move to the hits, and once more with
    each hit to its call.
    """
    spark = calls.sparkSession
    queries = calls.select(F.col("call_id").alias("query_id"), F.col("query").alias("text"))
    place = f"{shared_dir(spark)}/hits-{uuid.uuid4().hex}"
    search(queries).select("query_id", *key, "rank").write.parquet(place)
    wanted = spark.read.parquet(place)
    keys = wanted.select(*key).distinct()
    if keys.limit(LISTED_KEYS + 1).count() <= LISTED_KEYS:
        docs = docs.join(F.broadcast(keys), list(key), "left_semi")
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(wanted.count() / HITS_AT_ONCE))
    listed = F.array_sort(F.collect_list(F.struct("rank", F.struct(*payload).alias("hit"))))
    options = {"pretty": str(pretty).lower(), "ignoreNullFields": "false"}
    found = (
        docs.join(wanted, list(key))
        .repartition(parts, "query_id")
        .groupBy("query_id")
        .agg(listed.alias("_hits"))
        .select(
            F.col("query_id").alias("call_id"),
            F.to_json(F.transform("_hits", lambda h: h["hit"]), options).alias("output"),
        )
    )
    return (
        calls.select("call_id")
        .join(found, "call_id", "left")
        .select(
            "call_id",
            F.lit(OUTPUT_TYPE).alias("type"),
            F.coalesce("output", F.lit("[]")).alias("output"),
        )
    )


def open_calls(calls: DataFrame, outputs: DataFrame) -> DataFrame:
    """Calls that have no output yet."""
    return calls.join(outputs.select("call_id"), "call_id", "left_anti")


def conversation_status(log: DataFrame, calls: DataFrame) -> DataFrame:
    """``(conv_id, finished)``: whether the last model turn came without a call.

    ``calls`` carries the ``(conv_id, turn)`` of the model turn that made the call.
    """
    said = log.where(F.col("role") == MODEL_ROLE).select(
        "conv_id", F.col("turn").alias("said"), F.lit(None).cast("long").alias("called")
    )
    called = calls.select(
        "conv_id", F.lit(None).cast("long").alias("said"), F.col("turn").alias("called")
    )
    last = said.unionByName(called).groupBy("conv_id").agg(
        F.max("said").alias("said"), F.max("called").alias("called")
    )
    finished = F.col("said").isNotNull() & (
        F.col("called").isNull() | (F.col("called") < F.col("said"))
    )
    return last.select("conv_id", finished.alias("finished"))


def last_answer(log: DataFrame) -> DataFrame:
    """``(conv_id, answer)``: the last thing the model said."""
    said = log.where(F.col("role") == MODEL_ROLE)
    return said.groupBy("conv_id").agg(F.max_by("text", "turn").alias("answer"))


def round_count(log: DataFrame) -> DataFrame:
    """``(conv_id, rounds)``: number of model turns."""
    model = F.when(F.col("role") == MODEL_ROLE, 1)
    return log.groupBy("conv_id").agg(F.count(model).alias("rounds"))


def pool_hits(
    hits: DataFrame, num_results: int = 5, key: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Best hits per question over several searches for it.

    ``hits(question_id, query_id, *key, score)``: a document scores as in its best
    search, and ``found_by`` counts the searches that found it.
    """
    pooled = hits.groupBy("question_id", *key).agg(
        F.max("score").alias("score"), F.count("*").alias("found_by")
    )
    order = [F.desc("score"), *map(F.asc, key)]
    return top_k(pooled, num_results, order, by="question_id")
