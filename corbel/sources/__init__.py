"""Reading, writing and cataloguing tables."""
