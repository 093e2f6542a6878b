"""Operators for language-model training corpora, and the queries that bind them to the tables."""
