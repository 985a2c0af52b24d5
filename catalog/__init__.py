"""Registered queries, each next to the SQL that checks it on the same tables."""
