"""DataFrame operators of the pipeline and its monitoring layer."""
