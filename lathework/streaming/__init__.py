"""streaming of lathework."""
