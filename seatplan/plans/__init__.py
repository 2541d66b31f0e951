"""The seat-planning flow in the source's own names, and the queries over the driver tables."""
