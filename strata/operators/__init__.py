"""Relational operators of the layered model, each DataFrame -> DataFrame."""
