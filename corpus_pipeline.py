"""A training corpus from the documents table, in five stages.

``STAGES`` are (name, function) pairs. A function takes (spark, docs, sf_dir), where ``docs``
holds what the stage before kept, and returns a DataFrame; all but the last return the columns
of documents. ``run`` applies them, each result written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import id_fold, new_folder, prepared, scratch
from tidemark.llm.language import UNKNOWN, identify, least_familiarity, trained
from tidemark.llm.mixing import mix_sources, with_row_key
from tidemark.llm.near_duplicates import near_duplicate_classes
from tidemark.llm.packing import default_tokenizer, pack_documents
from tidemark.llm.personal import mask_personal_data
from tidemark.sources.files import remove_folder

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one of the languages of the corpus.

    Documents without a letter go, and those whose bytes are foreign to the language that fits
    them best: less familiar than nearly all held-out documents that were told rightly. All labelled documents
    take part, in full: those outside the held-out fold in the network and the counts of byte pairs, the others in the
    bound. If no document is labelled there is nothing to tell languages by, and all stay.
    """
    prepared(spark)
    network = trained(docs, on_all=True)
    if network is None:
        return docs.select(*COLUMNS)
    least = least_familiarity(docs, network, id_fold("doc_id", 3) == 1)
    found = identify(docs.select(*COLUMNS), network, familiarity="_likely").where(F.col("lang_pred") != UNKNOWN)
    if least is not None:
        found = found.where(F.col("_likely").isNull() | (F.col("_likely") >= least))
    return found.select(*COLUMNS)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id.

    Rows are told apart by a 64-bit hash of all their columns, so rows that share an id, or have none,
    go only if their texts are near duplicates. Of rows alike in every column one stays.
    """
    prepared(spark)
    # A hash and not a stored number: the texts would have to be stored with it.
    key = F.xxhash64(*COLUMNS, *[F.col(c).isNull() for c in COLUMNS])
    keyed = docs.select(*COLUMNS, key.alias("row_key"))
    classes = near_duplicate_classes(keyed, id_column="row_key").withColumnRenamed("doc_id", "row_key")
    named = classes.join(keyed.select("row_key", "doc_id"), "row_key")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    chosen = named.groupBy("component_id").agg(F.min(place).alias("place")).select("place.row_key")
    return keyed.join(chosen, "row_key", "left_semi").select(*COLUMNS).dropDuplicates()


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; no document goes."""
    prepared(spark)
    masked = mask_personal_data(docs.select(*COLUMNS))
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources reach their target weights.

    Each row is repeated by its own copies, whether its id is null, repeated or neither.
    """
    keyed = with_row_key(docs.select(*COLUMNS))
    copies = mix_sources(keyed, key_column="row_key").where("copies > 0").select("row_key", "copies")
    taken = keyed.join(copies, "row_key")
    return taken.select(*COLUMNS, F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")).drop("copy")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut the documents into sequences of power-of-two length."""
    prepared(spark)
    return pack_documents(docs, default_tokenizer())


STAGES = [
    ("language", known_language),
    ("near_duplicates", without_near_duplicates),
    ("personal_data", without_personal_data),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# The trained network, the drawn copies and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages. What a stage stores on its way goes when its result is written, and that when the
    next one's is, so unmasked texts don't stay in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for _, stage in STAGES[:-1]:
        path = new_folder(spark)
        with scratch(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before is not None:
            remove_folder(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
