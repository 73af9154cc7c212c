"""Queries of the training-data operators and the SQL of those that SQL can express."""

from __future__ import annotations

from realty_spark.llm import licences, line_dedup, near_dedup, substring_dedup, topk
from realty_spark.llm.hnsw import op10_neighbours
from realty_spark.llm.language import op4_language_id
from realty_spark.llm.licences import op5_licences
from realty_spark.llm.line_dedup import op12_line_dedup
from realty_spark.llm.mixing import op8_mixing
from realty_spark.llm.near_dedup import op1_near_dedup
from realty_spark.llm.packing import op7_packing
from realty_spark.llm.quality import op6_quality
from realty_spark.llm.spelling import op11_spelling_variants
from realty_spark.llm.substring_dedup import op9_substring_dedup
from realty_spark.llm.token_files import op2_token_files
from realty_spark.llm.topk import op3_top_k
from realty_spark.llm.whitening import op13_whitening

QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_token_files": op2_token_files,
    "op3_top_k": op3_top_k,
    "op4_language_id": op4_language_id,
    "op5_licences": op5_licences,
    "op6_quality": op6_quality,
    "op7_packing": op7_packing,
    "op8_mixing": op8_mixing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_neighbours": op10_neighbours,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_line_dedup": op12_line_dedup,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op1_near_dedup": near_dedup.ORACLE,
    "op3_top_k": topk.ORACLE,
    "op5_licences": licences.ORACLE,
    "op9_substring_dedup": substring_dedup.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
}
