"""Table builders and snapshot jobs composed from the operators."""
