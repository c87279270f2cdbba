"""Table builders (silver, gold), the data-quality engine and layer runs."""
