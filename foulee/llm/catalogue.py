"""Queries of this subpackage and the SQL that some of them are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from foulee.llm import (
    chat, decontaminate, exact_dedup, html_text, importance, language, line_dedup, packing, pii,
    simhash, spelling, token_counts, whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": pii.op1_pii,
    "op2_simhash": simhash.op2_simhash,
    "op3_language": language.op3_language,
    "op4_importance": importance.op4_importance,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_html": html_text.op7_html,
    "op8_packing": packing.op8_packing,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_spelling": spelling.op11_spelling,
    "op12_chat": chat.op12_chat,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op5_decontaminate": decontaminate.ORACLE_OP5,
    "op9_exact_dedup": exact_dedup.ORACLE_OP9,
    "op12_chat": chat.ORACLE_OP12,
}
