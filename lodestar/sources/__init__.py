"""Sources, sinks and catalog tasks."""
