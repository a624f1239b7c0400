"""Driver tables bound to the library's schemas, and one query per operator."""
