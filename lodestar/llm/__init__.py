"""Operators of a large-scale training-data pipeline.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries
(``lodestar.llm.plans``) only when it can be imported.
"""
