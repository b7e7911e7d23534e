"""Whole-job plan and the registered query catalog."""
