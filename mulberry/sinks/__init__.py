"""Results and inserts."""
