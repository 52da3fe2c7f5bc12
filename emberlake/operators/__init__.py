"""Relational operators of the climate model, each a DataFrame -> DataFrame plan."""
