"""End-to-end loads, composed from the operators."""
