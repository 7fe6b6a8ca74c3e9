"""Readers, writers and driver-table bindings."""
