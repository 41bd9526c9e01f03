"""Inputs and tables: files, the snapshot store, the active pointer."""
