"""Operators of a large-scale training-data pipeline over ``documents``.

One module per operator; ``queries`` registers the ten ``opN_`` queries and
``corpus_pipeline`` at the repository top chains four of them. Nothing else in
the library imports this subpackage.
"""
