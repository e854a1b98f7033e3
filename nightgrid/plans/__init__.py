"""The three phases of a study."""
