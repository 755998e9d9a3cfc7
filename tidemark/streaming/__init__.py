from tidemark.streaming.bronze import bronze_events, create_bronze_table, write_bronze
from tidemark.streaming.cleaning import clean_stream

__all__ = ["bronze_events", "clean_stream", "create_bronze_table", "write_bronze"]
