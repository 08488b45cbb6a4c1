"""Layer builders that compose the operators."""
