"""seatplan: capacity-planning analytics as plain Spark DataFrame functions."""
