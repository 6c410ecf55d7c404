"""regweave: weave registry extracts into trustworthy linked tables on Spark."""
