"""Training-data operators: ten document, conversation and media jobs on Spark.

Nothing outside this subpackage imports it. Each module holds one operator with its own general
interface and, at its end, the thin ``opN_`` query that derives the contract's columns from it.
"""
