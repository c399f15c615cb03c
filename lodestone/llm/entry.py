"""The queries of this subpackage, for ``__spark_entry__.py``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bigrams, jaccard, leaks, lines, media, negatives, pieces, quality, secret_scan, suffixes, turns, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": urls.op1_url_filters,
    "op2_ngram_jaccard": jaccard.op2_ngram_jaccard,
    "op3_media_columns": media.op3_media_columns,
    "op4_lm_scoring": bigrams.op4_lm_scoring,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_quality_classifier": quality.op6_quality_classifier,
    "op7_warc": warc.op7_warc,
    "op8_decontamination": leaks.op8_decontamination,
    "op9_suffix_dedup": suffixes.op9_suffix_dedup,
    "op10_line_dedup": lines.op10_line_dedup,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_secret_scans": secret_scan.op12_secret_scans,
    "op13_turn_repair": turns.op13_turn_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": urls.SQL,
    "op2_ngram_jaccard": jaccard.SQL,
    "op4_lm_scoring": bigrams.SQL,
    "op7_warc": warc.SQL,
    "op10_line_dedup": lines.SQL,
    "op11_hard_negatives": negatives.SQL,
    "op12_secret_scans": secret_scan.SQL,
}
