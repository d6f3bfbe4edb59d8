"""Whole jobs composed from sources and operators."""
