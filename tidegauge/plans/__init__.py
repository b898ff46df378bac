"""Plan shapes that keep hot keys spread over many tasks."""
