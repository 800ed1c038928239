"""Event-time transforms and the calls that run them as streams."""
