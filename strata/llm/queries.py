"""The registered queries of the operators: thin digests over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm.common import prepare, table

REGISTRY = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_minhash_near_dedup(spark, sf_dir):
    from strata.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query
def op2_winnowing_decontamination(spark, sf_dir):
    from strata.llm.decontaminate import decontaminate

    d = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"),
                      keep_columns=False)
    return d.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit",
                    F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                    (F.col("n_hit") > 0).alias("contaminated"))


@query
def op6_cuckoo_line_dedup(spark, sf_dir):
    from strata.llm.line_dedup import line_dedup

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs, threshold=10, min_chars=1).select(
        F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


@query
def op7_vector_best_fit_packing(spark, sf_dir):
    import public_tokenizers

    from strata.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                end_id=1, tokens=4096).drop("ids")


@query
def op9_centroid_language_id(spark, sf_dir):
    from strata.llm.language_id import fit_documents, held_out, identify

    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), fit_documents(docs)).select(
        F.col("row.doc_id").alias("doc_id"), "lang_pred", "score", "rejected",
    ).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query
def op5_entropy_secret_scan(spark, sf_dir):
    from strata.llm.secret_scan import KINDS, joined, scan

    d = scan(table(spark, sf_dir, "documents"), keep_columns=False)

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return d.select(F.col("row.doc_id").alias("doc_id"),
                    *[number(k).alias(f"n_{k}") for k in KINDS],
                    F.sha2(joined(kinds=KINDS[:3]), 256).alias("base_sha256"),
                    joined().alias("spans"))


@query
def op10_best_fit_sharding(spark, sf_dir):
    from strata.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query
def op3_token_files(spark, sf_dir):
    import public_tokenizers

    from strata.llm.token_files import read_tokens, write_tokens

    docs = table(spark, sf_dir, "documents")
    manifest = write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_tokens(manifest, docs.schema["doc_id"].dataType)


@query
def op4_ngram_quality_ratio(spark, sf_dir):
    from strata.llm.quality_ratio import fit, judge

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, fit(docs, table(spark, sf_dir, "labels"))).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "score")


@query
def op8_markov_url_filter(spark, sf_dir):
    from strata.llm.url_model import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"),
                       [("block", "net/"), ("allow", "example.net/en/"),
                        ("block", "example.com/de/"), ("allow", "org/fr/")])


@query
def op12_merkle_manifest(spark, sf_dir):
    from strata.llm.merkle import fold, leaf_digest, manifest, siblings

    number = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    small = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    claim = F.when(number % 5 == 0, leaf_digest(small))  # a null doc_id is never tampered with
    d = manifest(table(spark, sf_dir, "documents"), claim)
    return d.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(siblings(), 256).alias("proof_sha256"),
        fold(F.coalesce("claim", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op13_spelling_variants(spark, sf_dir):
    from strata.llm.spelling import spelling_variants, vocabulary

    docs = table(spark, sf_dir, "documents")
    prepare(spark)
    return spelling_variants(vocabulary(docs, min_chars=7, min_count=2, delete_every=31), ratio=10)


@query
def op11_positional_license_scan(spark, sf_dir):
    from strata.llm.license_scan import fit, scan

    docs = table(spark, sf_dir, "documents")
    d = scan(docs, fit(docs), keep_columns=False)

    def joined(labels):
        return F.concat_ws(",", F.array_sort(F.array_distinct(labels)))
    return d.select(
        F.col("row.doc_id").alias("doc_id"), "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"),
        joined(F.concat("places.label", "matches.label")).alias("labels"),
        # a base phrase is there in full
        F.when(F.size("places") > 0, 1.0).otherwise(
            F.coalesce(F.array_max("matches.score"), F.lit(0.0))).alias("score"))
