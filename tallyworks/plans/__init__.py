"""Whole jobs and reports."""
