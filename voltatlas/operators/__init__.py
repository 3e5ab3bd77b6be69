"""Curated and analytics models."""
