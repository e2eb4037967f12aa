"""Whole runs."""
