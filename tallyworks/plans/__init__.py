"""End-to-end compositions of the operators, and the query catalogue."""
