"""End-to-end plans built from the operators, plus the test views."""
