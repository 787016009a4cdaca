"""Registered queries of the operators for training data."""

from __future__ import annotations

from kinlink.llm.avi import op3_avi_media
from kinlink.llm.compression import op10_quality_classifier
from kinlink.llm.langid import op1_language_id
from kinlink.llm.lines import op8_line_dedup
from kinlink.llm.mixing import OP4_SQL, op4_mixing
from kinlink.llm.packing import op7_packing
from kinlink.llm.simhash import op9_simhash_near_dedup
from kinlink.llm.suffixes import op2_suffix_array_dedup
from kinlink.llm.urls import op5_url_filter
from kinlink.llm.vectors import op6_embedding_near_dedup

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_avi_media": op3_avi_media,
    "op4_mixing": op4_mixing,
    "op5_url_filter": op5_url_filter,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_packing": op7_packing,
    "op8_line_dedup": op8_line_dedup,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
}

ORACLE_SQL: dict[str, str] = {"op4_mixing": OP4_SQL}
