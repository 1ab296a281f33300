"""Word lists, rule tables and patterns: rules are data that operators take as arguments."""
