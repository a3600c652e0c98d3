from eventide.sinks.bitmap_store import BitmapStore
from eventide.sinks.tags import split_by_tag, write_tagged, write_tagged_stream
from eventide.sinks.writers import console_stream, show_prefixed, write_parquet

__all__ = ["BitmapStore", "split_by_tag", "write_tagged", "write_tagged_stream",
           "console_stream", "show_prefixed", "write_parquet"]
