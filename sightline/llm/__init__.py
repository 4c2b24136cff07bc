"""Training-data operators: ten operators over text and vector tables.

Each operator module has a general interface on DataFrames; ``queries``
registers one contract query per operator. Nothing outside this package
imports it.
"""
