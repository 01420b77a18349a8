"""A corpus pipeline: each stage works on what the one before it kept.

Stages take (spark, docs, sf_dir) and return the columns of docs, but for the last, which returns the mix.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.llm import decontam, langid, lines, minhash, mixing
from ledgerfold.llm.common import Workspace
from ledgerfold.storage import scope

#: Texts that need more phrases a symbol than this are in no learned language; prose needs a quarter of that.
MOST_PHRASES = 0.6
#: Of fewer symbols the number of phrases says too little.
LEAST_SYMBOLS = 20


def own_names(docs: DataFrame, *names: str) -> tuple[str, ...]:
    """These names, lengthened until docs has no column of them."""
    taken = {c.lower() for c in docs.columns}
    tail = ""
    while any((n + tail).lower() in taken for n in names):
        tail += "_"
    return tuple(n + tail for n in names)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a letter and texts in none of the languages of the labels.  Each row is judged by itself."""
    names = own_names(docs, "lang_pred", "score", "phrase_rate", "n_symbols")
    found = langid.annotated(docs, langid.learn(docs), names)
    pred, _, rate, size = (F.col(n) for n in names)
    return found.where((pred != "und") & ((size < LEAST_SYMBOLS) | (rate <= MOST_PHRASES))).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines of recurring templates from all documents but the first; documents themselves stay."""
    out = lines.drop_lines(docs, min_chars=1)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns) if "n_chars" in docs.columns else out.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates: the one with the smallest doc_id.  Rows without a doc_id are
    in no group and stay."""
    (gone,) = own_names(docs, "gone")
    drop = minhash.near_duplicates(docs).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(drop.hint("merge"), docs["doc_id"] == drop[gone], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose text holds a benchmark passage, whatever their doc_id."""
    (gone,) = own_names(docs, "gone")
    found = decontam.matches(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    drop = found.where(F.size("items") > 0).select(F.col("text_id").alias(gone)).distinct()
    return docs.join(drop, F.unhex(F.md5(docs["text"].cast("binary"))) == drop[gone], "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, taken of every document left."""
    return mixing.mix(docs)


STAGES = [
    ("language", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: Language identification and MinHash can't be told in SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of documents.parquet; of the stages before it, only what the last of them kept stays in the shared folder."""
    ws, last = Workspace(spark, "pipeline"), None
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with scope():
            docs = ws.put(stage(spark, docs, sf_dir), name)
        if last:
            ws.drop(last)
        last = name
    return STAGES[-1][1](spark, docs, sf_dir)
