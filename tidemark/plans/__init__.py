"""Table-specific jobs composed from the operators."""
