"""A bitemporal event ledger on Spark: append-only observations, folded into whatever was believed at any moment."""
