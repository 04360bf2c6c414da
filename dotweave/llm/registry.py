"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat_format, collocations, hard_negatives, jaccard_join, language_evidence, media_gif, pfair_mix, quality_cnn, scaled_sketch, secret_scan, tokenize_bpe, toxicity, warc

MODULES = (jaccard_join, toxicity, quality_cnn, pfair_mix, tokenize_bpe, language_evidence, media_gif, scaled_sketch, warc, chat_format, secret_scan, collocations, hard_negatives)


def queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def sql() -> dict:
    return {name: s for m in MODULES for name, s in m.SQL.items()}
