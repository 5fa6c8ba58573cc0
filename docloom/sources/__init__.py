"""Readers of the input tables and files."""
