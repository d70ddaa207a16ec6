"""firelog.sources."""
