"""sources of lathework."""
