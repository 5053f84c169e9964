"""plans of lathework."""
