"""functions of the snapshot-analytics jobs."""
