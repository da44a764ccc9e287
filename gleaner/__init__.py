"""Gleaner: a PySpark engine for crawled document corpora."""
