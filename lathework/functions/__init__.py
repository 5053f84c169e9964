"""functions of lathework."""
