"""Table operators of the session analysis."""
