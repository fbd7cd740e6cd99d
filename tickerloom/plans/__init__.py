"""Whole queries built from the operators: dimensions, facts, reports."""
