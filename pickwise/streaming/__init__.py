from pickwise.streaming.recs_job import StreamRecsJob, read_ratings_log, read_stream_recs
from pickwise.streaming.source import kafka_messages, parse_messages, text_messages

__all__ = ["StreamRecsJob", "kafka_messages", "parse_messages", "read_ratings_log",
           "read_stream_recs",           "text_messages"]
