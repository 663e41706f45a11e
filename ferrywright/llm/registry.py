"""The queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import audit, decontaminate, flac, importance, lines, mixing, packing, pii, quality, secrets, simhash, tokens, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_warc_revisits": warc.op1_warc_revisits,
        "op2_quality": quality.op2_quality,
        "op3_personal_data": pii.op3_personal_data,
        "op4_flac": flac.op4_flac,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_line_dedup": lines.op6_line_dedup,
        "op7_token_ids": tokens.op7_token_ids,
        "op8_simhash": simhash.op8_simhash,
        "op9_decontaminate": decontaminate.op9_decontaminate,
        "op10_secrets": secrets.op10_secrets,
        "op11_importance_resampling": importance.op11_importance_resampling,
        "op12_filter_audit": audit.op12_filter_audit,
        "op13_best_fit_packing": packing.op13_best_fit_packing,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_revisits": warc.ORACLE_SQL,
        "op5_mix_sources": mixing.ORACLE_SQL,
        "op11_importance_resampling": importance.ORACLE_SQL,
        "op12_filter_audit": audit.ORACLE_SQL,
    }
