"""Feed readers and layer inputs."""
