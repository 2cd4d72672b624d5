"""Which columns take part in an operation, and how its rows are joined."""
