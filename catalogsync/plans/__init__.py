"""The three phases of a run, each a composition of operators, and the run itself."""
