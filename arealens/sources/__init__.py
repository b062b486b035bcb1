"""Readers and payload flatteners."""
