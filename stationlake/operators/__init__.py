"""De-duplication, first-value picks, idempotent inserts, validation, control."""
