"""Structured Streaming drivers for the rate-limit and health operators."""
