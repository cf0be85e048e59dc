"""From raw documents to token ids: toxicity, near-duplicates, decontamination, personal data, BPE.

Each stage takes all its predecessor kept and returns the columns of documents, but
for the last, which adds the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, decontam, pii, setsketch, toxicity
from barloom.llm.frames import table
from barloom.llm.queries import vocabulary
from barloom.sources.scratch import materialize


def _with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' own columns, ``n_chars`` counted anew."""
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("bigint")).select(columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, score="_score", predicted="_predicted")
    return scored.where("_predicted = 0").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that of the smallest id. Similarity 0.8 on five words."""
    found = setsketch.near_duplicates(docs, setsketch.Near(size=5, percent=80))
    dropped = materialize(found.where("not kept").select("doc_id").distinct(), "dropped")
    return docs.join(dropped, "doc_id", "left_anti").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; in others, the runs of words that benchmark items share are cut."""
    found = decontam.scan(docs, table(spark, sf_dir, "benchmark"), prefix="_", cut=True)
    return _with_text(found.where("not _contaminated"), docs.columns)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pii.detect(docs)
    return _with_text(pii.redact(found), docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids, and the text as decoded from these."""
    return bpe.roundtrip(docs, vocabulary())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("personal_data", redact_personal_data),
    ("byte_level_bpe", tokenize),
]

#: The stages learn classifiers, sketch sets and merge bytes, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
