"""Complete queries."""
