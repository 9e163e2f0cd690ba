"""Sources and sinks: table IO, the copy manifest, staging fixtures."""
