"""Column functions and the one Arrow parsing step."""
