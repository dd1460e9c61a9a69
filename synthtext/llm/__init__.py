"""Operators of a training-data pipeline over Spark DataFrames.

One module per operator; ``queries`` registers one query for each. Nothing
outside this folder (and ``corpus_pipeline.py``) imports it.
"""
