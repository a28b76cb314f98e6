"""Materialisation and stage wiring."""
