"""Readers, writers and builders of the delivery star schema."""
