"""The corpus pipeline: stages over whole tables, each written and read again.

Quality, near-duplicates and decontamination drop documents, the mix drops and
repeats them, and the last stage encodes what is left. A stage begins by releasing the scratch
tables of the stages before it, whose results are written by then: write a stage's
result before the next one is called, as run() does.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import get_ident

from pyspark.sql import DataFrame, SparkSession

from ferrywright.llm import common, decontaminate, mixing, quality, simhash, tokens


#: Scratch tables of the stage before, by the thread that runs the stages, so that runs at the same time leave each other's alone.
_scratch: dict[int, list[str]] = {}


def _stage(work: Callable) -> Callable:
    """A stage that first releases the scratch tables of the stage before it in this thread's run, and no others of the session."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.release(spark, _scratch.pop(get_ident(), []))
        # What this thread stages meanwhile, whatever others do.
        with common.staging() as staged:
            out = work(spark, docs, sf_dir)
        _scratch[get_ident()] = staged
        return out

    return run_stage


@_stage
def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps.

    A null text counts as an empty one, and both are judged like any other; null ids and columns are carried;
    very long texts are read whole; equal texts get equal scores, so ties and repeated rows stay or go together;
    an empty table stays empty; columns of any name, clashing ones too, are carried.
    """
    return quality.keep_good(docs)


@_stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that with the smallest doc_id.

    Null and empty texts and texts without words are one group; rows without a doc_id come after all others; of
    repeated rows of one id one stays; very long texts are read whole; an empty table stays empty; columns of any
    name, clashing ones too, are carried.
    """
    return simhash.drop_near_duplicates(docs)


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whole or edited.

    Null and empty texts hold nothing and stay; null ids are carried; very long texts are aligned whole, in memory
    that goes with the text; repeated rows stay or go together; an empty table stays empty, and without items all
    documents stay; columns of any name, clashing ones too, are carried.
    """
    return decontaminate.drop_contaminated(docs, common.table(spark, sf_dir, "benchmark"))


@_stage
def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them.

    A null source is a source of its own, the last; null and empty texts have size 0 and are taken at their
    source's rate; equal sizes are ordered by doc_id, nulls last, then by the row's number in the table that is
    staged here, so that repeated rows are counted each; an empty table stays empty; columns of any name are carried.
    """
    return mixing.mix_documents(docs)


@_stage
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document of the token shards: doc_id, start, n_tokens, ids_crc32.

    A null or empty text is the end id alone; a null doc_id sorts last; repeated rows keep a row each, in the order
    of their texts' hashes; a very long text has a shard of its own; an added token's string in a text is that
    token, as the library has it; an empty table gives no row; extra columns are left out.
    """
    return tokens.encode_corpus(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Fingerprints, alignments and trained scorers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stage(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
