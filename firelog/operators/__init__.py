"""firelog.operators."""
