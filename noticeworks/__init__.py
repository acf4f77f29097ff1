"""Public-notice analytics as lazy PySpark DataFrame operators."""
