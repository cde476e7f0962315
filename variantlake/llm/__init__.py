"""Operators for preparing training text, each a DataFrame function.

One module per operator; ``queries`` registers one thin query per operator and
``corpus_pipeline.py`` at the top of the repository chains five of them. Nothing
else in the library imports this subpackage.
"""
