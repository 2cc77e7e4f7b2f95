"""Relational building blocks: ordered work, joins, aggregates, sets, reshaping."""
