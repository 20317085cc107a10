"""Operators of a training-data pipeline, each by its own method, and their registered queries."""
