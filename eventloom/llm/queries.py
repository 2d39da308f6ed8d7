"""The operators' queries, by the names under which the catalogue registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op10_bpe
from .decontaminate import op7_decontaminate
from .language import op5_language
from .lines import OP2_SQL, op2_lines
from .packing import op9_packing
from .pages import op8_pages
from .pii import op3_pii
from .quality import op1_quality, op1_sql
from .secrets import op6_secrets, op6_sql
from .simhash import op4_simhash, op4_sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_lines": op2_lines,
        "op3_pii": op3_pii,
        "op4_simhash": op4_simhash,
        "op5_language": op5_language,
        "op6_secrets": op6_secrets,
        "op7_decontaminate": op7_decontaminate,
        "op8_pages": op8_pages,
        "op9_packing": op9_packing,
        "op10_bpe": op10_bpe,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality": op1_sql(), "op2_lines": OP2_SQL, "op4_simhash": op4_sql(), "op6_secrets": op6_sql()}
