"""Filters, joins, aggregates, ordered folds, sequences, paging and table changes."""
