"""Loads that follow arriving files."""
