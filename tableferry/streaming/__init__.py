"""Loads that continue where the last one stopped: marks and streams."""
