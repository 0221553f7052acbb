"""Reads (CSV, JDBC, tables) and the path-based table sink."""
