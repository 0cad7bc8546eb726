"""From `documents` to packed training sequences: five stages, each written as Parquet before the next reads it.

quality      documents whose quality score is below 0.3 go
near_copies  one document of each group linked by n-gram Jaccard similarity stays
repeats      every byte in a 200-byte string that occurs elsewhere too goes
mixture      documents in the order of a Pfair schedule of source weights
packed       pieces of documents in sequences of 4096 tokens (the result)
"""

from pyspark.sql import functions as F

from delaycast.llm import jaccard, mixing, packing, quality, queries, suffix
from delaycast.llm.kit import ship, spared, stored, table


def good_quality(spark, docs, sf_dir):
    """Learns from the labels of the training folds; a null text is scored as an empty one. A column of the score's name stays as it is."""
    ship(spark)
    labels = table(spark, sf_dir, "labels").where(queries.fold("doc_id", 5) != 0)
    model = quality.fit(docs, labels)
    rows, named = spared(docs, [quality.SCORE])
    return named(quality.score(rows, model).where(F.col(quality.SCORE) >= 0.3).drop(quality.SCORE)).select(*docs.columns)


def near_copies(spark, docs, sf_dir):
    """Rows without an id stay."""
    ship(spark)
    return jaccard.one_of_each(docs)


def repeats(spark, docs, sf_dir):
    """A document of which no word is left goes; a null text becomes an empty one."""
    ship(spark)
    return suffix.without_repeats(docs)


def mixture(spark, docs, sf_dir):
    """All rows, range-partitioned and sorted by slot, so that reading the files in order is reading the mixture. Columns of the schedule's names stay as they are."""
    new = ["mix_source", "mix_start", "mix_block", "mix_slot"]
    rows, named = spared(docs, new)
    mixed = mixing.mix(rows, queries.MIX_WEIGHTS, queries.MIX_OTHERS, queries.MIX_BLOCK_CHARS)
    order = ["mix_slot", "mix_start", "doc_id"]
    return named(mixed.repartitionByRange(*order).sortWithinPartitions(*order).drop(*new)).select(*docs.columns)


def packed(spark, docs, sf_dir):
    ship(spark)
    return packing.pack_documents(docs, f"{queries.TOKENIZERS}/word_bpe_49k.json")


STAGES = [("quality", good_quality), ("near_copies", near_copies), ("repeats", repeats), ("mixture", mixture), ("packed", packed)]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
