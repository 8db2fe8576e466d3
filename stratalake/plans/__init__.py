"""Composed jobs and SQL serving."""
