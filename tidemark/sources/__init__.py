"""Readers and writers at the edge of a job."""
