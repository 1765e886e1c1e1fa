"""Training-data operators: thirteen operators, their driver queries and SQL.

Nothing outside this package imports it except the guarded hook in
``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""
