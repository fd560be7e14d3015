from broadsheet.streaming.collect import collect_batch, start_collect
from broadsheet.streaming.counts import hourly_collection, interval_counts
from broadsheet.streaming.dedup import stream_dedup

__all__ = ["collect_batch", "hourly_collection", "interval_counts", "start_collect", "stream_dedup"]
