"""Queries: marts over the folds, their tests, and the graph that builds them."""
