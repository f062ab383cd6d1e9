"""Importing this module registers every query of the subpackage."""

from skyledger.llm import (  # noqa: F401
    align,
    ann,
    fixity,
    langid,
    linededup,
    mixing,
    negatives,
    packing,
    quality,
    secret_scan,
    simhash,
    substrings,
    topk,
)
from skyledger.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
