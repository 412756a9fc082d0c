"""Readers and writers of layered tables."""
