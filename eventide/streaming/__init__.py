"""The same jobs as unbounded queries."""
