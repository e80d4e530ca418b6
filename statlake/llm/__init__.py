"""Operators of a training-data pipeline: ten numbered operators and their registered queries."""
