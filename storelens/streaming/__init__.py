from storelens.streaming.incremental import delta_since, stream_bronze, stream_upsert, upsert

__all__ = ["delta_since", "stream_bronze", "stream_upsert", "upsert"]
