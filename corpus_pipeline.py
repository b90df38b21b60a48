"""Corpus pipeline: five stages from raw documents to framed token records.

Each stage is a function (spark, docs, sf_dir) over everything its predecessor
kept; all but the last return the columns of ``documents``. ``run`` writes each
stage's rows as Parquet below the shared ``spark.checkpoint.dir`` and reads them back, so
that a lost executor costs one stage's tasks and no lineage grows.

1. language ID: a conditional random field, learned from rows with a language,
   labels every text; texts without a language (null, empty, no letters) and
   texts whose best language holds under ``MIN_SHARE`` of the words go;
2. near-duplicates: of documents whose SimHash fingerprints link at two bits or fewer,
   one stays (smallest doc_id);
3. decontamination: documents with a window like a benchmark item go;
4. mixing: documents repeat or go so that sources meet their target weights;
5. token records: ids are framed, written, and read back.

Nulls, empty tables and repeated rows: as each operator says. Extra columns of
the input pass through to the fourth stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import decontaminate, langid, mixing, records, simhash
from farebox.llm.common import table, written

MIN_SHARE = 0.3
SHINGLE_WORDS, MAX_BITS = 3, 2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents with a language."""
    model = langid.fit(docs)
    # clashing names of extra columns are kept out of the operator's way; the text passes once
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("row")
    named = langid.identify(docs.select("text", rest), model)
    kept = named.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= MIN_SHARE))
    return kept.select(*["text" if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group."""
    return simhash.keep_one(docs, SHINGLE_WORDS, MAX_BITS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order."""
    inner = docs.select("doc_id", "text", "source", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"))
    return mixing.training_order(inner).select("whole.*")


def write_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the records written."""
    return records.encode_to_files(spark, docs.select("doc_id", "text"))


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", decontaminated),
    ("mix_sources", mix_sources),
    ("token_records", write_records),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


#: Learned labels and token ids are beyond SQL.
ORACLE_SQL = None
