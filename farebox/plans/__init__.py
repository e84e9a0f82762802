"""Named query plans over the driver tables (``catalog``) and their DuckDB
SQL twins (``oracle``)."""
