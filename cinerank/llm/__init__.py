"""Operators of a large-scale training-data pipeline over ``documents``,
``embeddings``, ``pages``, ``labels`` and ``conversations``. Nothing outside this
subpackage imports it (only ``__spark_entry__.py`` adds its queries, if present)."""
