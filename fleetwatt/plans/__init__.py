"""Building blocks that decide how work is spread over tasks."""
