"""operators of lathework."""
