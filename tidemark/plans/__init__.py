"""plans of the snapshot-analytics jobs."""
