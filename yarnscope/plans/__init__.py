"""Named query plans over the driver tables, each with a DuckDB oracle.

``registry.queries()`` maps a name to ``fn(spark, sf_dir) -> DataFrame``;
``registry.oracle_sql()`` maps the same names to SQL that computes the
expected answer straight from the table columns (an independent path).
"""
