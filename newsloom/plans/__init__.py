"""Bronze, silver and gold jobs composed from the operators."""
