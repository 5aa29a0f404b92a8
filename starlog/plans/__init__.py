"""The jobs a user runs, as DataFrame functions with the rule variants as parameters."""
