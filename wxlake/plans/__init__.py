"""Whole jobs over a lake folder."""
