"""Independent DuckDB SQL formulations of every registered query (the oracle)."""
