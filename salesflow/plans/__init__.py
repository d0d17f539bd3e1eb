"""End-to-end flows composed of the other packages."""
