"""Operators of a training-data pipeline (see README, section on llm)."""
