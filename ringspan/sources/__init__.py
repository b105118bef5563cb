"""Readers, writers, replay."""
