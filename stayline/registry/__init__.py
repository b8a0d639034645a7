"""Registered queries over the test tables, and SQL that must agree with them."""
