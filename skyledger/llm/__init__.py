"""Operators for preparing training data: one module per operator, each with its
query ``opN_<name>``; ``queries`` collects them. Nothing outside this folder
imports it.
"""
