"""Complete jobs put together from the sources, functions, operators and sinks."""
