"""Message fixtures, the query catalog with its SQL twins, and whole jobs."""
