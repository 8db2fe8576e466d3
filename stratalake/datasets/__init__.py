"""Ready-made dataset specs."""
