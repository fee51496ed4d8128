"""Composite plans: the pipeline's user-visible tables as DataFrame functions."""
