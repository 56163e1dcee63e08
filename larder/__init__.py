"""Catalogue and ratings analytics on Spark: raw files to keyed tables, search and ranking."""
