"""Readers and writers for labelled splits, label maps and reports."""
