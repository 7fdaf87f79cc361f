"""Ocean-colour analytics as Spark DataFrame and Column operators."""

__version__ = "0.1.0"
