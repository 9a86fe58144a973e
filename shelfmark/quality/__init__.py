"""Checks of every layer. Each returns findings: ``level, where, check, n, sample``."""
