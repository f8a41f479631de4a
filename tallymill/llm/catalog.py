"""Imports every module that registers corpus queries."""

from tallymill.llm import (  # noqa: F401
    decontamination,
    language,
    max_sketches,
    near_duplicates,
    nearest,
    packing,
    personal_data,
    quality,
    set_join,
    sharding,
    token_counts,
    toxicity,
    vector_codes,
)
from tallymill.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
