"""Purchase-spend and supplier-risk analytics as composable Spark DataFrame functions."""
