"""Writers: Parquet, CSV, JSON Lines, YAML streams, JDBC, versioned publishing."""
