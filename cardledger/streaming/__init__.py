"""Structured Streaming jobs for authorizations and account inquiries."""
