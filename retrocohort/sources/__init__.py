"""Table bindings, delimited files and sinks."""
