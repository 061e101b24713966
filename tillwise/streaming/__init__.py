"""Sales files picked up as they arrive."""
