"""Feed and record operators."""
