"""Sources: line scans with a stable position, delimiter-separated record
scans, headerless integer CSVs, and the report reader."""
