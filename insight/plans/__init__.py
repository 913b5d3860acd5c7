"""Named analyses built from the operators, and the query registry."""
