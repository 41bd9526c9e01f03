"""DataFrame-to-DataFrame operators without I/O."""
