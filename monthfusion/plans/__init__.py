"""Whole plans: analog sources and the bronze-to-gold update."""
