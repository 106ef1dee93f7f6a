"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes all documents its predecessor kept, and every stage but the last returns the
columns of documents. ``run`` writes what a stage returns as Parquet under
``spark.checkpoint.dir`` and the next stage reads that table. Null text counts as empty
throughout; repeated rows, null ids and clashing extra columns are treated as each stage's
operator states, and an empty table gives an empty result in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewright.llm.durable import stored
from tablewright.llm.line_runs import drop_repeated_runs
from tablewright.llm.mixing_tree import mixed_documents
from tablewright.llm.packing import packed_digests
from tablewright.llm.pu_quality import learn_quality, text_score
from tablewright.llm.simhash_index import drop_near_duplicates


def _sized(docs: DataFrame) -> DataFrame:
    """Texts that were cut have new lengths."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from this folder's labels, does not reject.

    A null text is scored as an empty one; rows with a null id cannot be labelled and are
    scored like others; repeated rows are scored each, ids labelled both ways are not trusted. Other
    columns pass through. Without trusted labels every score is one half and all rows stay.
    """
    _, model = learn_quality(spark, docs, sf_dir)
    return docs.filter(text_score(model) >= 0.3)


def drop_line_runs(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of runs of lines.

    A row stays even if nothing is left of its text; a null text becomes an empty one. The
    earliest document by id (null last) keeps a run; rows equal in id and text are one document
    and get one result. Whole texts of any length are read. ``n_chars`` follows the text.
    """
    return _sized(drop_repeated_runs(docs).select(*[F.col(f"`{c}`") for c in docs.columns]))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each class of close SimHash fingerprints.

    The operator's own measures: shingles of four words, links at four or fewer differing
    bits of 64. Null, empty and wordless texts share one fingerprint and so are one class. Of
    rows that share the smallest id (or have none) one stays. Columns pass through as they are.
    """
    return drop_near_duplicates(docs, words=4, distance=4)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by source, a row per document and pass over its source.

    A null source is a source of its own; documents without words, null texts among them, are
    never drawn. Equal rows are drawn each for itself, and the same rows give the same mix. A whole
    pass returns the text as it is, a partial one its drawn blocks. ``n_chars`` follows the text.
    """
    return _sized(mixed_documents(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens.

    A null text is packed as an empty one, which is its closing id alone; repeated rows and null
    ids are packed each for itself.
    """
    return packed_digests(docs)


STAGES = [
    ("quality_classifier", reject_low_quality),
    ("line_dedup", drop_line_runs),
    ("near_dedup", one_of_each),
    ("mixing", mix),
    ("packing", pack),
]

#: No SQL: the classifier is trained, and packing needs a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
