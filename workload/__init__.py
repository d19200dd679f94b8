"""The check workload: every operator run over the driver tables, with its DuckDB twin."""
