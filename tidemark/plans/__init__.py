"""Composed runs over the tables."""
