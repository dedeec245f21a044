"""Readers and writers: test-data star, CSV inputs, Parquet star, JDBC."""
