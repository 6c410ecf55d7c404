"""Measures over dated and priced records: survival, indices, matches, drift, lateness, ranks."""
