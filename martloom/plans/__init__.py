"""Models wired together."""
