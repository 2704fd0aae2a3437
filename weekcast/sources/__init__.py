"""Readers, writers, schemas and adapter views."""
