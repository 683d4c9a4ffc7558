"""Fixed lookup files (CSV)."""
