"""Relational steps over lines, fields and events."""
