"""Incremental forms of the folds and of change detection."""
