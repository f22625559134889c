"""Reading feeds, parsing them, and writing tables."""
