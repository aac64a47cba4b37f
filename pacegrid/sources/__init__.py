"""Readers for raw files and payloads, and the table loads."""
