"""Registered queries over the given tables, with SQL that states their results."""
