"""Reusable relational operators: currency ranking, joins, merges, components, scoring."""
