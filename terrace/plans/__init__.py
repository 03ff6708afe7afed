"""Whole jobs: the players pipeline and the query registry."""
