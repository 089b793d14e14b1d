"""Corpus pipeline over ``documents``: five stages, each on all rows that the one before kept.

1. language ID: documents that the models reject go (no letters, or unlike
   every language's own texts);
2. near duplicates: of each group of similar texts the row of smallest doc_id
   stays; unlike texts all stay, whatever their doc_id;
3. decontamination: benchmark passages are cut out of texts, and documents
   that are mostly benchmark go;
4. mixing: sources are weighted by temperature; no document is lost, rare
   sources repeat;
5. token ids: packed files in doc_id order, read back as one row a document.

``run`` writes each stage's rows to the shared folder as Parquet and reads them
back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common
from tessera.llm.decontam import build, decontaminate
from tessera.llm.langid import identify
from tessera.llm.mixing import mix_sources
from tessera.llm.partenum import keep_one_of_each
from tessera.llm.queries import fit_language_models
from tessera.llm.token_store import read_tokens, write_tokens
from tessera.session import scratch_dir

#: Hit words above which a document goes whole, as a share of its words.
MAX_COVERAGE = 0.5
#: Weights as even as this share of the greatest entropy, repeating no source more than this.
TARGET_ENTROPY, MAX_REPEATS = 0.97, 1.5
TOKENIZER = "word_bpe_49k.json"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # what else a document has stays beside its text, under one name, so that no column of the stage's own clashes
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    found = identify(docs.select(others, "text"), *fit_language_models(docs)).filter(~F.col("rejected"))
    return found.select(*["text" if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs, one_row_an_id=False)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, build(common.table(spark, sf_dir, "benchmark")), MAX_COVERAGE)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    others = F.struct(*[c for c in docs.columns if c != "text"]).alias("row")
    mixed = mix_sources(docs.select(others, "doc_id", "source", "text"), TARGET_ENTROPY, MAX_REPEATS)
    return mixed.select(*["text" if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest = write_tokens(docs, public_tokenizers.path(TOKENIZER), scratch_dir(spark, "token-ids"))
    return read_tokens(spark, manifest)


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("token_ids", token_ids)]

#: Language models, similarity components and tokenizers are beyond SQL: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
