"""Readers and writers: text files, star-schema parquet, table sinks."""
