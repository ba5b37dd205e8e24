"""Reading events, and the stored rollup tables."""
