"""Registered queries with their SQL, and the end-to-end jobs."""
