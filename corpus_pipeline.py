"""Cleaning of a text corpus in stages, each written and read again."""

from __future__ import annotations

from txnspark.llm.pipeline import ORACLE_SQL, STAGES, run

__all__ = ["ORACLE_SQL", "STAGES", "run"]
