"""The same sources and operators over arriving files."""
