"""sources of the snapshot-analytics jobs."""
