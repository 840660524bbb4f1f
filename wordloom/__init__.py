"""Keyword search and search analytics over text tables, as Spark jobs."""

from wordloom.config import SearchConfig, SectionIndex

__all__ = ["SearchConfig", "SectionIndex"]
