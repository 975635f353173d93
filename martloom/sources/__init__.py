"""Where the ten input tables come from."""
