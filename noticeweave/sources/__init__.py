"""Readers of tables and raw documents."""
