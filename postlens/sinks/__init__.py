"""Writers: partitioned lake, raw data set, parquet, JDBC."""
