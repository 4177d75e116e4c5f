"""Readers and result stores."""
