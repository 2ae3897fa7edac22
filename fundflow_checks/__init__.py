"""Registered queries, their SQL counterparts and the feeds both read."""
