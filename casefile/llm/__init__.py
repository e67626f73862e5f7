"""Operators of a training-data pipeline, each a DataFrame -> DataFrame function.

Nothing else in the library imports this package; `__spark_entry__` adds its
queries (`casefile.llm.queries`) only when the package is present.
"""
