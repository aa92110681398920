"""Batch jobs and reports."""
