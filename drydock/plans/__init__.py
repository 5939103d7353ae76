"""End-to-end dataflows and the query catalogue."""
