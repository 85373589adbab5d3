"""Event validation, snapshot publishing and the streaming queries."""
