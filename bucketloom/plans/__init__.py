"""Plans that put operators together: the registered queries, the pipeline and its checkpoint, tiering."""
