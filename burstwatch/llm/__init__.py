"""Operators of a training-data pipeline over documents and embeddings.

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries. Every operator reads only the columns that it names, so
extra or clashing columns of its input do not matter.
"""
