"""Operators that prepare text corpora for model training.

Nothing outside this package imports it; ``__spark_entry__`` registers its
queries only when it is present.
"""
