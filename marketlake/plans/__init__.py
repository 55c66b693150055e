"""Composite jobs: gold mart, serving queries, reconciliation and the query catalog."""
