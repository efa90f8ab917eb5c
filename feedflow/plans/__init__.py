"""Whole dataflows, the feed derived from tables, and the registered queries."""
