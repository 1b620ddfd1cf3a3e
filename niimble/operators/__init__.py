"""DataFrame -> DataFrame operators. Each docstring states the grain of its result."""
