from encore.streaming.cleaning import cleaned_activity_stream, read_interaction_stream, start_activity_query

__all__ = ["cleaned_activity_stream", "read_interaction_stream", "start_activity_query"]
