"""From source tables to named queries."""
