"""Raw table schemas and readers, sinks, and the test-data mapping."""
