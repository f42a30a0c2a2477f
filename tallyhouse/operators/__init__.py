"""Relational operators over DataFrames: numbering, joins, grouping, sets, order."""
