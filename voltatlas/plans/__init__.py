"""Exploration queries, dashboard queries and the refresh job."""
