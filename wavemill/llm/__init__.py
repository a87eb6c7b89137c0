"""Operators for preparing language-model training corpora.

Nothing outside this package imports it; ``wavemill.llm.queries`` registers its queries.
"""
