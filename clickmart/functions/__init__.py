"""Column helpers: PostgreSQL semantics and the segment CASE chains."""
