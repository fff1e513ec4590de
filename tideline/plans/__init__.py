"""Operators put together into the tables of a run."""
