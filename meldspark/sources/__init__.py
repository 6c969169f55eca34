"""Readers: delimited text, JSON Lines, YAML streams, Parquet, JDBC, literals, dictionaries."""
