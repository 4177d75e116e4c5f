"""Quality checks, scoring and end-to-end runs."""
