"""operators of the snapshot-analytics jobs."""
