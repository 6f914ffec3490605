"""vachan: speech-transcript analytics as Spark DataFrame and Column operators."""
