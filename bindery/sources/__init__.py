"""Scans. Every source has an explicit schema; nothing is inferred."""
