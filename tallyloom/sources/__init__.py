"""Message sources and result sinks."""
