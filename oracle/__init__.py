"""DuckDB text for the correctness check: plain SQL over the same parquet tables."""

from .statements import STATEMENTS

__all__ = ["STATEMENTS"]
