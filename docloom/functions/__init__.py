"""Column builders: no shuffle, no Python at run time."""
