"""Training-data operators: token counts, deduplication, packing, quality, language.

Each module holds one operator with its own general interface; ``queries.py``
binds them to the ``documents`` table under the names ``opN_<name>`` and
``oracle.py`` holds DuckDB SQL for those that SQL can express. Nothing else in
the library imports this subpackage.
"""
