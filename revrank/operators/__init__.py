"""Relational operators on log, users, items and recommendations."""
