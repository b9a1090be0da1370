"""Jobs composed from operators."""
