"""firelog.streaming."""
