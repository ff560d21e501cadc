"""The results pipeline, composed of the general operators."""
