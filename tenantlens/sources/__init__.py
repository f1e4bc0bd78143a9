"""Landed JSON, generated calendar and the table store."""
