"""The analytics jobs, composed from the operators."""
