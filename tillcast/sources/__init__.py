"""Reading facts and dimensions, keyed history tables."""
