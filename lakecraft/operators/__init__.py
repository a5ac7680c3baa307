"""Relational operators of the catalog: projections, dedup, joins, vectors, lifecycle, quality."""
