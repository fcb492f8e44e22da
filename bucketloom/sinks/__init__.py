"""Where rollup rows go."""
