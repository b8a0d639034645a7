"""Complete batch jobs built from the operators."""
