"""DataFrame operators shared by batch and streaming plans."""
