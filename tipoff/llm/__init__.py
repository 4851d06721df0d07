"""Training-data operators: text and vector jobs for large corpora.

Nothing else in the library imports this subpackage.
"""
