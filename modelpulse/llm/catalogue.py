"""All queries of this package."""

from modelpulse.llm import (  # noqa: F401
    byte_bpe,
    decontamination,
    fixity,
    hard_negatives,
    html_text,
    license_scan,
    line_dedup,
    near_dedup,
    quality,
    secret_scan,
    spelling,
    substring_dedup,
    toxicity,
)
from modelpulse.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
