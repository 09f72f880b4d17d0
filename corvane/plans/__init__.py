"""Whole queries and the query facade."""
