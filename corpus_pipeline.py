"""A corpus from raw documents to token ids: STAGES are applied in order, each to all its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm import bpe, langid, mixing, simhash, substring
from rowtide.llm.common import stored, table

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
# A document stays if its main language has at least this share of its letters.
LANGUAGE_SHARE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those where no language holds ``LANGUAGE_SHARE`` of the letters."""
    found = langid.identify(docs, langid.fit(docs), spans=False, carry=True)
    kept = found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LANGUAGE_SHARE))
    return kept.select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id; repeated rows stay once. Rows that
    share an id but not their text are judged each by its own text. Rows without id stay."""
    return simhash.representatives(docs, shingle=3, distance=2).select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go; ``n_chars`` follows. Other texts stay as they are, and a text
    that loses all its words stays as an empty one."""
    found = substring.remove_duplicates(docs, window=13, verbatim=True, carry=True)
    changed = F.col("n_removed") > 0
    columns = {c: F.col("kept") if c == "text" else F.col(f"row.{c}") for c in docs.columns}
    columns["n_chars"] = F.when(changed, F.length("kept")).otherwise(F.col("row.n_chars")).cast("long")
    return found.select(*(value.alias(name) for name, value in columns.items()))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in the order of the mix: part files in the order of their names, rows in the order they have."""
    mixed = mixing.mix(docs, carry=True, growing=False)
    return mixed.repartitionByRange("position").sortWithinPartitions("position").select("row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, position, n_tokens, ids_sha256, decoded_sha256, ids``; ids are packed as little-endian 32-bit numbers.

    ``position`` is the place in the mix, which neither the files read nor the rows written keep: it depends on ids and
    sources alone, so it is counted again here. Sorting by it gives the order of the mix."""
    mixed = mixing.mix(docs, carry=True, growing=False).select(F.struct("doc_id", "position").alias("id"), F.col("row.text").alias("text"))
    # stored, as encoding reads it twice and rows of equal id must keep their places
    found = bpe.digests(stored(mixed, "tokens-mixed"), RANKS, public_tokenizers.PATTERN, id_col="id", ids=True)
    return found.select("id.*", *found.columns[1:])


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", passages),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

# Hashing, model fitting and merges are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written to the shared folder and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.split()[0].lower()}")
    return STAGES[-1][1](spark, docs, sf_dir)
