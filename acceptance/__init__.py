"""Acceptance queries: every registered query, with the SQL that gives its expected result."""
