"""Operators on the log and its catalog: filters, projections, joins, windows, snapshots."""
