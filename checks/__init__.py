"""Registered queries over the sample tables, each with the SQL it must equal."""
