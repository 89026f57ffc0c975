"""Incremental processing of a growing directory of scans."""
