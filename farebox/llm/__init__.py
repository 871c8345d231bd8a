"""Operators of a large-scale training-data pipeline.

Self-contained: nothing else in the library imports this subpackage, and
``__spark_entry__.py`` adds its queries only when it is present.
"""
