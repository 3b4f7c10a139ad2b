"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from . import chat, oracles
from .chat import op4_chat_format
from .decontaminate import op2_decontaminate
from .html_extract import op3_html_extract
from .license_scan import op9_license_scan
from .nearest import op8_nearest
from .packing import op1_best_fit_packing
from .quality import op5_quality
from .simhash import op10_simhash
from .substring_dedup import op7_substring_dedup
from .suffix_dedup import op6_suffix_dedup

QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_decontaminate": op2_decontaminate,
    "op3_html_extract": op3_html_extract,
    "op4_chat_format": op4_chat_format,
    "op5_quality": op5_quality,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_nearest": op8_nearest,
    "op9_license_scan": op9_license_scan,
    "op10_simhash": op10_simhash,
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontaminate": oracles.DECONTAMINATE,
    "op4_chat_format": chat.ORACLE_SQL,
    "op7_substring_dedup": oracles.SUBSTRINGS,
}
