"""DataFrame-to-DataFrame operators, sinks and tables."""
