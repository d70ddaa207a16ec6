"""firelog.plans."""
