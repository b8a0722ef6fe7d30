"""Models and metrics composed from the operators."""
