"""Operators and the pipeline for preparing training text."""
