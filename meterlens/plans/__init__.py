"""Composite jobs: the full analytics pipeline and the scaling experiment."""
