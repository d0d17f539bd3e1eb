"""Structured Streaming: the message bus, the lake writer and the speed views."""
