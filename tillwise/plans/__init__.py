"""Order of work: full build, one monthly batch, checks."""
