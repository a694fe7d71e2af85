"""Pure Column helpers."""
