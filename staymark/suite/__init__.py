"""The queries registered for checking, and the SQL that says what they must return."""
