"""Incremental merge and the streaming form of the comment filter."""
