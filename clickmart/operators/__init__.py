"""Operators the models need beyond built-ins: dedup, global ranking, data checks."""
