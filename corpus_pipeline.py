"""From raw documents to packed training sequences, in stages that end in Parquet tables.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of ``docs``. A row is known by its id and text, so rows with equal or null ids are
documents of their own unless their texts are equal too.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seekframe.llm import mixing, packing, quality_model, quality_rules, simhash
from seekframe.llm.common import stored, table, text_of

MIN_SCORE = 0.7

#: The pipeline is not expressible in SQL: a trained model and a linear program are in it.
ORACLE_SQL = None

_KEY = "_pipeline_key"


def _key() -> Column:
    return F.struct(F.col("doc_id"), F.xxhash64(text_of()).alias("text_hash"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the cascade."""
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"))
    return quality_rules.judge_quality(whole).where("kept").select("row.*")


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled raw documents, scores as good."""
    model = quality_model.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(quality_model.quality_score(spark, model, F.col("text")) >= MIN_SCORE)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest key."""
    keyed = docs.withColumn(_KEY, _key())
    groups = simhash.near_duplicates(keyed, key=_KEY)
    kept = groups.where(F.col(_KEY) == F.col("component_id")).select(_KEY)
    return (
        keyed.join(kept.distinct(), _KEY, "left_semi").dropDuplicates([_KEY]).select(docs.columns)
    )


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes their words: never, once or twice.

    The part of a document that is taken beyond whole copies is rounded to one or none by a
    hash of its key, so that a source keeps its share of words.
    """
    keyed = docs.withColumn(_KEY, _key())
    mixed = mixing.mix_sources(keyed, key=_KEY)
    size = F.greatest(F.col("size"), F.lit(1))
    chance = F.pmod(F.xxhash64(_KEY, F.lit("copy")), F.lit(1 << 20)) / float(1 << 20)
    copies = (
        mixed.groupBy(_KEY)
        .agg(F.sum(F.col("taken") / size).alias("times"))
        .select(_KEY, F.floor(F.col("times") + chance).cast("int").alias("copies"))
        .where("copies > 0")
    )
    copied = keyed.dropDuplicates([_KEY]).join(copies, _KEY)
    again = copied.withColumn(_KEY, F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return again.select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
