"""Whole queries: reads over versions and the registered plans."""
