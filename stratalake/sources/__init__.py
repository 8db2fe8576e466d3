"""Where data comes from and goes to: landing files, their manifest, and layer tables."""
