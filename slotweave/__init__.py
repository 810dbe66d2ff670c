"""Search-query slot tagging on Spark."""
