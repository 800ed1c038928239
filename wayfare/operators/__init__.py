"""Building blocks that keep hot groups and large sides spread over tasks."""
