"""The corpus pipeline: documents to packed training sequences in five stages.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but
the last return the columns of ``documents``. Each result is written as Parquet to the shared
folder and read back as the next stage's input, so a lost executor costs one stage at most. What
a stage wrote on its way is removed once its result stands, and a result once the next one does.

Rows with null or repeated ids and extra columns pass through all stages; what each operator does
with them stands in its docstring. Null and empty texts have no language and go in the first
stage. An empty table gives no rows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import intermediates, materialise, remove, table, unpack
from strata.llm.decontaminate import decontaminate
from strata.llm.language_id import fit_documents, identify
from strata.llm.line_dedup import line_dedup
from strata.llm.near_dedup import near_duplicates
from strata.llm.packing import pack

#: No SQL: the language model, the tokenizer and the packing have no SQL form. Tests compare
#: the run with a brute-force version.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is near the centroid of a learned language; others go."""
    judged = identify(docs, fit_documents(docs))
    return unpack(judged.where(~F.col("rejected")), docs.columns)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that stand in ten documents and more leave every text; n_chars follows."""
    d = line_dedup(docs, threshold=10, min_chars=1)
    changed = F.col("n_dropped") > 0
    new = {"text": F.col("kept_text"),
           "n_chars": F.when(changed, F.char_length("kept_text"))
           .otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)}
    return d.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return unpack(near_duplicates(docs).where("keeper"), docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    judged = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return unpack(judged.where("n_hit = 0"), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, packed into sequences of 4096."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1, tokens=4096)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", without_common_lines),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with intermediates() as written:
            docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        remove(spark, before + written[:-1])
        before = written[-1:]
    return docs
