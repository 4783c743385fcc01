from layerkit.streaming.drain import ProgressLog, logged_drain, stream_source, stream_to_table
from layerkit.streaming.messages import decode_messages, encode_messages

__all__ = [
    "ProgressLog",
    "logged_drain",
    "stream_source",
    "stream_to_table",
    "decode_messages",
    "encode_messages",
]
