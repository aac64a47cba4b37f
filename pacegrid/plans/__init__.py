"""Whole jobs: test-data bindings, the layered pipeline, registered queries."""
