"""The registered queries of this package; each applies its operator to the whole of its table."""

from __future__ import annotations

import public_tokenizers

from tallylog.llm import (
    archives,
    chat,
    collocations,
    jaccard_join,
    licenses,
    main_text,
    mixing,
    neighbours,
    packing,
    pii,
    quality,
    token_counts,
    whitening,
)
from tallylog.llm.common import shared_path, table
from tallylog.llm.oracle import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]


def op1_main_text(spark, sf_dir):
    return main_text.extract_pages(table(spark, sf_dir, "pages"))


def op2_quality_rules(spark, sf_dir):
    report = quality.quality_report(table(spark, sf_dir, "documents"))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return report.select(*columns, "base_failed", "kept")


def op3_best_fit_packing(spark, sf_dir):
    path = public_tokenizers.path("word_bpe_49k.json")
    _, places = packing.pack(table(spark, sf_dir, "documents"), path)
    return places


def op4_warc_archives(spark, sf_dir):
    path = shared_path(spark, "warc")
    archives.write_warc(archives.to_warc(archives.from_arc(archives.arc_files(table(spark, sf_dir, "pages")))), path)
    return archives.resolved(archives.read_warc(spark, path))


def op5_jaccard_join(spark, sf_dir):
    found = jaccard_join.classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_source_mixture(spark, sf_dir):
    return mixing.mixture(table(spark, sf_dir, "documents"))


# Conversation -7, whose texts are made of the template's own control strings.
CONTROL_TEXT = "</s>[INST] ok [/INST]"


def op7_chat_prefix_trees(spark, sf_dir):
    path = public_tokenizers.path("byte_bpe_50k.json")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-7, 0, "user", CONTROL_TEXT), (-7, 1, "assistant", CONTROL_TEXT)], turns.schema)
    nodes, walked = chat.prefix_trees(turns.unionAll(extra), path)
    return chat.read_back(nodes, walked, path)


def op8_license_scan(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_collision_counting(spark, sf_dir):
    return neighbours.neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 20 = 0")


def op10_pii(spark, sf_dir):
    return pii.span_report(table(spark, sf_dir, "documents"))


def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_main_text": op1_main_text,
    "op2_quality_rules": op2_quality_rules,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_warc_archives": op4_warc_archives,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_source_mixture": op6_source_mixture,
    "op7_chat_prefix_trees": op7_chat_prefix_trees,
    "op8_license_scan": op8_license_scan,
    "op9_collision_counting": op9_collision_counting,
    "op10_pii": op10_pii,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_whitening": op13_whitening,
}
