"""Role mapping of the driver tables (``roles``), the registered queries
(``catalog``), their DuckDB oracles (``oracles``) and the end-to-end jobs on
files in their original formats (``jobs``)."""
