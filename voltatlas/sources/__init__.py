"""Paged JSON source, landing of pages as typed tables, and the table layers."""
