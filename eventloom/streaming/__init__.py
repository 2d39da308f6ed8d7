"""Progress over days. The feed is processed in daily batches; nothing here is a continuous query."""
