"""End-to-end compositions that stage and publish tables."""
