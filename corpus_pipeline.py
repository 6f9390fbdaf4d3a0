"""A corpus, from raw documents to token records: five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet and reread as the next stage's documents. All but the last
return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers

from kinfold.llm import decontaminate, mixing, ngram_join, quality, records
from kinfold.llm.shared import dropped, written


def quality_classifier(spark, docs, sf_dir):
    """Documents that the co-trained classifier accepts, with all their columns.

    Null and empty texts are judged by their metadata alone; whole texts of any
    length are scored; repeated rows are judged alike; a probability of exactly
    0.5 accepts quality and rejects toxicity; without labels of both classes
    nothing is rejected; no documents give none; other columns, of whatever name,
    stay (but p_quality, p_toxic and accepted aren't returned).
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, model).filter("accepted").select([f"`{c}`" for c in docs.columns])


def ngram_jaccard_join(spark, docs, sf_dir):
    """One document of each group of near copies, that of the smallest id, with all its columns.

    Null, empty and blank texts are near nothing and stay, as do rows of null
    id; rows that share an id stay or go together, so repeated rows of the
    smallest id all stay; pairs at exactly the similarity are near; texts count
    whole; no documents give none; other columns of any name stay.
    """
    return ngram_join.one_per_group(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents that hold no window like a benchmark item, with all their columns.

    Null and empty texts stay; whole texts are searched; rows that share an id
    with a contaminated one go; windows at exactly the similarity are like the
    item; items without words match nothing; no documents or items change
    nothing; other columns of any name stay.
    """
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark, docs, sf_dir):
    """Documents as often as the mix takes them, with all their columns.

    Null sources are one source, the last; documents without words are taken as
    often as their source is taken whole; rows that share an id are taken alike;
    equal hashes are taken together or not at all; no documents give none; other
    columns of any name stay.
    """
    return mixing.mixed_documents(docs)


def token_records(spark, docs, sf_dir):
    """What is read back from the token records of all documents: doc_id, start, n_tokens, ids_crc32.

    Null and empty texts have the end id only; texts are encoded whole; repeated
    rows are records of their own; null ids come first; rows of one id follow
    the hashes of their texts; no documents give no rows; other columns, of
    whatever name, aren't read.
    """
    return records.token_records(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("token_records", token_records),
]

#: The classifier and the tokenizer can't be put in SQL; tests/llm/test_queries.py holds the run against a plain version.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, from the documents table to the rows of the token records. A stage's rows go when the next one's are written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, f"stage-{name}")
            if before:
                dropped(spark, before)
            before = docs.inputFiles()[0].rpartition("/")[0] if docs.inputFiles() else None
    return docs
