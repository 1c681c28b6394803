"""salesmart: a sales warehouse written as Spark DataFrame operators."""
