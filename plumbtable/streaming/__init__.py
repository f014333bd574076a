"""Stateless stream scoring."""
