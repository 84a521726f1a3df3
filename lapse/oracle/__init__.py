"""DuckDB SQL oracles for the correctness checks (never used by the Spark jobs)."""
