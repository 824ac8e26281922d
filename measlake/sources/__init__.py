"""Readers: each turns files, or a DataFrame of (path, content), into rows."""
