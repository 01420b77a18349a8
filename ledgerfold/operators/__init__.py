"""Operators over the event log: appends, folds, change capture, joins."""
