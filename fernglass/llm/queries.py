"""The registered queries of this subpackage: thin calls of its operators on whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from fernglass.llm import embed_dedup, exact_dedup, hmm_lm, html_main, langid, minhash, mixing, packing, token_counts, toxicity


def _table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op3_mixing(spark, sf_dir):
    """taken is the sum of what the placed uses of a document take; position is where the first of them begins."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    taken = F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + w)
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), F.size("positions").alias("uses"), F.round(F.get("positions", F.lit(0)), 9).alias("position"))


def op9_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op2_minhash(spark, sf_dir):
    return minhash.near_dedup(_table(spark, sf_dir, "documents"))


def op1_langid(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs)).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_hmm(spark, sf_dir):
    return hmm_lm.train_and_score(_table(spark, sf_dir, "documents"))


def op4_embed_dedup(spark, sf_dir):
    return embed_dedup.near_dedup(_table(spark, sf_dir, "embeddings"))


def op6_html_main(spark, sf_dir):
    return html_main.main_text(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_token_counts(spark, sf_dir):
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {
    "op1_langid": op1_langid,
    "op2_minhash": op2_minhash,
    "op3_mixing": op3_mixing,
    "op4_embed_dedup": op4_embed_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_html_main": op6_html_main,
    "op7_hmm": op7_hmm,
    "op8_token_counts": op8_token_counts,
    "op9_packing": op9_packing,
    "op10_toxicity": op10_toxicity,
}
SQL = {"op2_minhash": minhash.SQL, "op3_mixing": mixing.SQL, "op4_embed_dedup": embed_dedup.SQL, "op5_exact_dedup": exact_dedup.SQL}
