"""Training-data operators: one module per operator, each with a general
``DataFrame -> DataFrame`` interface and a thin registered query.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
"""
