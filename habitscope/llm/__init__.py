"""Operators for training-data pipelines over document tables.

One module for each operator; ``words`` and ``rows`` are shared helpers; ``queries`` binds
them to the test tables. Nothing outside this folder and ``corpus_pipeline`` imports it.
"""
