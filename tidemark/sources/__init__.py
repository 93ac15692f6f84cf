"""Sources, result tables and intermediate storage."""
