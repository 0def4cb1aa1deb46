"""Storing differences and audit events."""
