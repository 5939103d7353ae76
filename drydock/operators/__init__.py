"""DataFrame-to-DataFrame operators, all usable through ``df.transform``."""
