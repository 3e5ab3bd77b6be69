"""Checks of the jobs against SQL on the given tables."""
