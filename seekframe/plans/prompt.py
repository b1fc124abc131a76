"""From hits to contexts, prompts and messages, one row or more per query."""

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seekframe.functions.text import required, strip, tokens

# The wording of prompts and messages.
INSTRUCTIONS = """
Your task is to answer questions from the course participats based on the provided context. 
Use the content to find relevant information and provide accurate answers.
If the answer is not found in the context, respond with "I don't know."
"""
PROMPT_TEMPLATE = "QUESTION: \n    {question}\n\nCONTEXT:\n    {context}"
QUESTION_MARK, ANSWER_MARK = "Q: ", "A: "
FILENAME_MARK, CONTENT_MARK = "Filename: ", "Content: "
INSTRUCTION_ROLE, PROMPT_ROLE = "developer", "user"


def faq_block(section: str = "section", question: str = "question", answer: str = "answer") -> Column:
    """Lines of one FAQ hit."""
    return F.concat(
        required(section),
        F.lit(f"\n{QUESTION_MARK}"),
        required(question),
        F.lit(f"\n{ANSWER_MARK}"),
        required(answer),
    )


def chunk_block(filename: str = "filename", content: str = "content") -> Column:
    """Lines of one file chunk hit."""
    return F.concat(
        F.lit(FILENAME_MARK),
        required(filename).cast("string"),
        F.lit(f"\n{CONTENT_MARK}"),
        required(content),
    )


def build_context(
    queries: DataFrame,
    hits: DataFrame,
    docs: DataFrame,
    block: Column,
    key: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``(query_id, context)``: the blocks of a query's hits in rank order.

    A query without hits keeps its row with an empty context. Whether the hits are broadcast
    to the documents is left to Spark, which knows their size when they have been found.
    """
    wanted = hits.select("query_id", *key, "rank")
    blocks = F.array_sort(F.collect_list(F.struct("rank", F.col("_block"))))
    contexts = (
        docs.join(wanted, list(key))
        .select("query_id", "rank", block.alias("_block"))
        .groupBy("query_id")
        .agg(blocks.alias("_blocks"))
        .select(
            "query_id",
            strip(F.array_join(F.transform("_blocks", lambda b: b["_block"]), "\n\n")).alias(
                "context"
            ),
        )
    )
    return (
        queries.select("query_id")
        .join(contexts, "query_id", "left")
        .select("query_id", F.coalesce("context", F.lit("")).alias("context"))
    )


def fill_template(template: str, **values: Column) -> Column:
    """``template`` with its ``{name}`` places taken by columns; braces in them are safe."""
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(values[name])
    return F.concat(*pieces)


def build_prompts(
    queries: DataFrame, contexts: DataFrame, template: str = PROMPT_TEMPLATE
) -> DataFrame:
    """``(query_id, prompt)`` from ``queries(query_id, text)`` and their contexts."""
    prompt = fill_template(template, question=required("text"), context=F.col("context"))
    return queries.join(contexts, "query_id").select("query_id", prompt.alias("prompt"))


def retrieve_prompts(
    queries: DataFrame,
    hits: DataFrame,
    docs: DataFrame,
    block: Column,
    key: tuple[str, ...] = ("doc_id",),
    template: str = PROMPT_TEMPLATE,
) -> DataFrame:
    """``(query_id, prompt)``: the table handed to a model.

    ``hits(query_id, *key, rank)`` may come from any search of this package or another.
    """
    contexts = build_context(queries, hits, docs, block, key)
    return build_prompts(queries, contexts, template)


def build_messages(prompts: DataFrame, instructions: str = INSTRUCTIONS) -> DataFrame:
    """``(query_id, turn, role, content)``: instructions, then the prompt."""
    pair = F.array(
        F.struct(F.lit(INSTRUCTION_ROLE).alias("role"), F.lit(instructions).alias("content")),
        F.struct(F.lit(PROMPT_ROLE).alias("role"), F.col("prompt").alias("content")),
    )
    return prompts.select("query_id", F.posexplode(pair).alias("turn", "m")).select(
        "query_id", F.col("turn").cast("long").alias("turn"), "m.role", "m.content"
    )


def usage_totals(
    log: DataFrame, prices: DataFrame, by: str = "conv_id", text: str = "text"
) -> DataFrame:
    """``(by, tokens, cost)`` over a message log, by the token rule of the keyword index.

    ``prices(role, price)`` holds one row per role, the price being that of a token.
    """
    counted = log.withColumn("_n", F.size(tokens(F.col(text))).cast("long"))
    per_role = counted.groupBy(by, "role").agg(F.sum("_n").alias("_n"))
    return (
        per_role.join(prices, "role", "left")
        .groupBy(by)
        .agg(
            F.sum("_n").alias("tokens"),
            F.round(F.sum(F.col("_n") * F.coalesce("price", F.lit(0.0))), 9).alias("cost"),
        )
    )
