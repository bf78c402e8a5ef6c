"""Registered queries of the corpus operators and their DuckDB oracles."""

from __future__ import annotations

from importlib import import_module

#: query name -> module of this subpackage that defines it
MODULES = {"op1_simhash": "simhash", "op2_quality": "quality",
           "op3_html_text": "html_text", "op4_token_files": "token_files", "op5_chat": "chat",
           "op6_decontaminate": "decontaminate", "op7_bpe": "bpe", "op8_pii": "pii",
           "op9_licenses": "licenses", "op10_token_counts": "token_counts",
           "op11_language": "language", "op12_whitening": "whitening", "op13_fill_middle": "fill_middle"}

#: query names that have DuckDB SQL over the same tables (ORACLE_SQL of their module)
ORACLES = ("op2_quality", "op5_chat", "op6_decontaminate", "op9_licenses", "op13_fill_middle")


def queries() -> dict:
    return {name: getattr(import_module(f".{m}", __package__), name) for name, m in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {n: import_module(f".{MODULES[n]}", __package__).ORACLE_SQL for n in ORACLES}
