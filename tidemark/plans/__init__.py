"""Configuration and jobs."""
