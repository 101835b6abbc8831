"""Sources and sinks: files, HTTP, paginated lists, and staged publication."""
