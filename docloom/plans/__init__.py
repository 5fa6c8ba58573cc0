"""Queries: operators applied to the tables of an input folder."""
