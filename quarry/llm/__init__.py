"""Operators of a training-data pipeline (dedup, packing, extraction, scoring).

Nothing else in the library imports this subpackage.
"""
