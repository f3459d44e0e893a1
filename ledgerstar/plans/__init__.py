"""Chains, stored-layer stages, business questions, query registry and SQL oracle."""
