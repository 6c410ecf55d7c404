"""Column-to-column rules; each is a pure expression Catalyst can plan."""
