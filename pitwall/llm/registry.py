"""Queries of the numbered operators: key -> builder, and SQL where it can say the same."""

from __future__ import annotations

from pitwall.llm import op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13

MODULES = [op1, op2, op3, op4, op5, op6, op7, op8, op9, op10, op11, op12, op13]

QUERIES = {k: v for m in MODULES for k, v in m.QUERIES.items()}
ORACLE = {k: v for m in MODULES for k, v in m.ORACLE.items()}
