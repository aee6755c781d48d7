"""Shipped table specifications."""
