"""Readers, writers, views, caching and scratch space."""
