"""Operators for building language-model training corpora.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; :mod:`helioframe.llm.queries` registers the
thin ``opN_*`` queries on top of them.
"""
