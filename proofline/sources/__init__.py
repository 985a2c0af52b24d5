"""Readers, writers and the derived views used to exercise the operators."""
