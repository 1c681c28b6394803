"""Sources, sinks and seed tables."""
