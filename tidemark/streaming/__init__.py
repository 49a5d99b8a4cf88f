"""streaming of the snapshot-analytics jobs."""
