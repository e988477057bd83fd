"""Operators for preparing training text: duplicates, language, scoring, mixing, contamination, toxicity, pages, quality.

Nothing else in the library imports this package. Each module ``opN_name`` has the operator with its
parameters and a thin query of the same name; ``queries`` registers those queries and their SQL.
"""
