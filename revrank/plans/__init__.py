"""Recommenders: fit on a log, return the best k items per user."""
