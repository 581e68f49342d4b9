"""Operators for preparing training text: counting, scanning, tokenising, filtering, deduplicating, searching.

Each operator module takes and returns DataFrames and knows no test tables;
`registry` binds them to the tables as queries. Nothing outside this folder
imports from it but the entry module and `corpus_pipeline`.
"""
