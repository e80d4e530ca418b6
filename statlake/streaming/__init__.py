"""Incremental loading: cursors, watermarks, status and stream-driven merges."""
