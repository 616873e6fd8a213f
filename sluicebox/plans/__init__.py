"""Queries: staging, the session mart, and the reports on it."""
