"""Models, reports and the month load built from the operators."""
