"""Readers, writers and checks of record, truth and id-list files."""
