"""Visit-report analytics on PySpark: intake, validation, visitor metrics, control state."""
