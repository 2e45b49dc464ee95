"""tradelens package."""
