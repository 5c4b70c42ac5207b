"""Relational operators shared by the models."""
