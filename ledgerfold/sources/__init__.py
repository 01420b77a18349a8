"""Readers of what sources publish, the landing zone, and a client for live sources."""
