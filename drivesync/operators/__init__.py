"""Batch operators of the change-capture, chunking and apply engine."""
