"""From raw documents to token digests: five stages, each on what the one before it kept.

Toxic documents go, one document of each group of near duplicates stays, personal
data is masked, sources are mixed to target weights (documents of sources that are
asked for more than they have occur once per epoch), and the mix is encoded.

Cases, in all stages: a null text counts as empty, is clean, stays null where it is masked
and has no tokens; null ids, languages and sources are values like others; empty texts and
texts of equal words are copies of one another, of which one stays; rows that are
repeated are copies too; long texts are read whole; an empty table passes as an empty
table; columns beside the five of the table are carried along, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stayline.llm import bpe, mixing, ngram_join, pii, toxicity
from stayline.llm.registry import MIX, RANKS, domain_of
from stayline.staging import stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, learned from the labelled ones among them, does not call toxic."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word similarity 0.8."""
    return ngram_join.one_of_each(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by the name of its kind."""
    return pii.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of domain, language and source ask for."""
    domain = "domain"
    while domain in docs.columns:
        domain += "_"
    levels = (domain, *MIX.levels[1:])
    mix = mixing.Mix(levels, MIX.weights, MIX.default, MIX.share, MIX.max_epochs, MIX.seed)
    return mixing.mixed(docs.withColumn(domain, domain_of()), mix).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row."""
    return bpe.digests(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("tokens", encode),
]

#: The first two stages fit a model and search by hashing, so no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what a stage returns is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
