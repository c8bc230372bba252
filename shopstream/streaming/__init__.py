"""Stream forms of the operators that keep state per device, and the stream join."""
