"""Incremental runs of batch jobs over file streams."""
