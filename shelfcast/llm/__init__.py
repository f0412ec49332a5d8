"""Operators for preparing language-model training text.

Nothing outside this package imports it; ``corpus_pipeline.py`` and the driver entry
point are its only users.  Every operator takes DataFrames and returns DataFrames.
"""
