"""Column functions: native expressions only, usable in batch and streaming queries alike."""
