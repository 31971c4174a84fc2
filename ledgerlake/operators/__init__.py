"""Relational building blocks that several tables share."""
