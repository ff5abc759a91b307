"""Operators for preparing large text corpora for language-model training.

One module per operator, each with a general DataFrame interface; ``queries``
holds the thin registered queries. Nothing else in the library imports this
subpackage.
"""
