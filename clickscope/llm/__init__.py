"""Training-data operators at corpus scale, each a Spark job over whole tables.

Nothing else in the library imports this subpackage; ``__spark_entry__``
registers :func:`clickscope.llm.queries.queries` when it can be imported.
"""
