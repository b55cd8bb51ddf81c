"""All queries of this subpackage."""

from importlib import import_module

from tickloom.llm.registry import ORACLES, QUERIES

for _part in ("token_queries", "corpus_queries", "score_queries", "scan_queries"):
    import_module(f"tickloom.llm.{_part}")

__all__ = ["ORACLES", "QUERIES"]
