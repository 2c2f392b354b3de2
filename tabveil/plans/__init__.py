"""End-to-end jobs that chain the operators."""
