"""Parameters of SQL text, and a builder that applies clauses in SQL's order."""
