"""DataFrame operators over the domain tables."""
