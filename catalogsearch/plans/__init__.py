"""End-to-end flows: index and retrieve."""
