"""The operators as named queries over the given tables, with the SQL that must agree with them."""

from __future__ import annotations

import public_tokenizers

from tripmill.llm import (
    collocations,
    exact_dedup,
    html_text,
    jaccard,
    language,
    lm_scoring,
    mixing,
    packing,
    quality,
    repeats,
    token_counts,
    toxicity,
    vector_codes,
)
from tripmill.llm.common import table

#: A public tokenizer installed beside Python on every machine, and its pattern of words.
TOKENIZER, PATTERN = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN


def op1_quality_rules(spark, sf):
    return quality.judge(table(spark, sf, "documents"))


def op2_lm_scoring(spark, sf):
    return lm_scoring.score_corpus(table(spark, sf, "documents"))


def op3_jaccard_join(spark, sf):
    return jaccard.classes(table(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op4_best_fit_packing(spark, sf):
    return packing.pack_documents(table(spark, sf, "documents"), TOKENIZER, PATTERN)


def op5_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf, "labels")))


def op6_exact_dedup(spark, sf):
    return exact_dedup.report(table(spark, sf, "documents"))


def op7_mixing(spark, sf):
    return mixing.mix(table(spark, sf, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op8_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    return language.identify(docs, language.train(docs))


def op9_html_extraction(spark, sf):
    return html_text.extract(table(spark, sf, "pages"))


def op10_token_counts(spark, sf):
    return token_counts.count(table(spark, sf, "documents"), TOKENIZER, PATTERN)


def op11_vector_codes(spark, sf):
    return vector_codes.compress(table(spark, sf, "embeddings"))


def op12_collocations(spark, sf):
    return collocations.top(collocations.mine(table(spark, sf, "documents")))


def op13_substring_dedup(spark, sf):
    return repeats.report(table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_lm_scoring,
        op3_jaccard_join,
        op4_best_fit_packing,
        op5_toxicity,
        op6_exact_dedup,
        op7_mixing,
        op8_language_id,
        op9_html_extraction,
        op10_token_counts,
        op11_vector_codes,
        op12_collocations,
        op13_substring_dedup,
    )
}
ORACLES = {
    "op1_quality_rules": quality.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op7_mixing": mixing.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_substring_dedup": repeats.ORACLE,
}
