"""DuckDB oracle SQL for every registered query (see ``oracle.sql.ORACLE``)."""
