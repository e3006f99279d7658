"""Incremental refresh of reports from newly staged files."""
