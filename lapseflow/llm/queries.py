"""Importing this module registers all queries of the subpackage."""

from __future__ import annotations

from lapseflow.llm import collocations, decontamination, fingerprints, html_text, licenses, line_dedup, manifest, mixing, near_duplicates, quality, token_counts, toxicity, url_reputation  # noqa: F401
from lapseflow.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
