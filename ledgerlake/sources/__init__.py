"""Readers. Every function takes the session and a location, and returns a DataFrame."""
